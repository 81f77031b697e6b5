"""Token counts by offset-mapped attribution (operator 6).

Each whole document is encoded once. Token lengths in bytes, summed up, give every
token's byte span (spans of tokens of a byte-level tokenizer tile the text), and token
spans are interval-joined with the spans of fields or sections by binary search. Rule
for a token that crosses a boundary: it counts once, for the span that holds most of its
bytes, and for the earlier one if two hold as many; tokens that no span touches are
counted as section -1. Sections are lines, each with its line break, unless ``spans``
names a column of array<struct<start,end>> in code points, sorted and not overlapping.

Defined results: null or empty text has one empty section with no token; bytes that are no
UTF-8 count as replacement characters; null ids and repeated rows get their own rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_process, small_batches, text_bytes
from .packing import tokenizer_path

TOKENIZER = "byte_bpe_50k.tiktoken"
SCHEMA = "section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


class Encoder:
    """A byte-level tokenizer and its tokens' lengths in bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """End of each token, in bytes."""
        return np.cumsum(self.size[np.asarray(self.enc.encode_ordinary(text), np.int64)])


def attribute(ends: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Tokens per span, tokens outside all spans, and tokens per span that cross its end."""
    n = len(lo)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    first = np.searchsorted(hi, starts, "right")  # first span that ends after the token's start
    home = np.full(len(ends), -1, np.int64)
    best = np.zeros(len(ends), np.int64)
    at, live = first.copy(), np.arange(len(ends))
    while len(live):
        live = live[at[live] < n]
        live = live[lo[at[live]] < ends[live]]
        if not len(live):
            break
        k = at[live]
        over = np.minimum(ends[live], hi[k]) - np.maximum(starts[live], lo[k])
        more = over > best[live]
        home[live[more]], best[live[more]] = k[more], over[more]
        live = live[ends[live] > hi[k]]
        at[live] += 1
    got = home[home >= 0]
    cross = got[best[home >= 0] < (ends - starts)[home >= 0]]
    return np.bincount(got, minlength=n), int((home < 0).sum()), np.bincount(cross, minlength=n)


def line_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, line breaks included."""
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    hi = np.concatenate((breaks, [len(text)])) if not len(breaks) or breaks[-1] < len(text) else breaks
    return np.concatenate(([0], hi[:-1])), hi


def char_to_byte(text: bytes) -> np.ndarray:
    """Byte offset of each code point, and of the end."""
    raw = np.frombuffer(text, np.uint8)
    return np.concatenate((np.flatnonzero((raw & 0xC0) != 0x80), [len(text)]))


def token_counts(docs: DataFrame, spans: str | None = None, path: str | None = None) -> DataFrame:
    """doc_id, section, start, end (code points), n_tokens, n_crossing, doc_tokens: a row per section, and one for section -1 if tokens fall outside."""
    small_batches(docs.sparkSession)

    def run(batches):
        where = path or tokenizer_path(TOKENIZER)
        enc = per_process(f"encoder:{where}", lambda: Encoder(where))
        for batch in batches:
            given = batch.column(2).to_pylist() if spans else [None] * batch.num_rows
            which, columns = [], [[] for _ in range(6)]
            for row, (text, own) in enumerate(zip(text_bytes(batch.column(1)), given)):
                shown = (text or b"").decode("utf-8", "replace")
                text = shown.encode()  # bytes that are no UTF-8 count as replacement characters
                ends = enc.ends(shown) if text else np.zeros(0, np.int64)
                bounds = char_to_byte(text)
                if spans:
                    own = [s for s in own or [] if s and s["start"] is not None and s["end"] is not None]
                    edge = lambda k: bounds[np.clip(np.array([s[k] for s in own], np.int64), 0, len(bounds) - 1)]  # noqa: E731, B023
                    lo, hi = edge("start"), edge("end")
                else:
                    lo, hi = line_spans(text)
                n, outside, cross = attribute(ends, lo, hi)
                section = np.arange(len(lo))
                a, b = np.searchsorted(bounds, lo), np.searchsorted(bounds, hi)
                if outside:
                    section, a, b, n, cross = np.append(section, -1), np.append(a, 0), np.append(b, len(bounds) - 1), np.append(n, outside), np.append(cross, 0)
                which += [row] * len(section)
                for column, values in zip(columns, (section, a, b, n, cross, np.full(len(section), len(ends)))):
                    column.append(values)
            cat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), pa.array(cat[0].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in cat[1:])], ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *([spans] if spans else [])).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
