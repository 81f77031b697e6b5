"""SimHash near-duplicates through a byte-position inverted index (operator 2).

A fingerprint is eight bytes. Two fingerprints that differ in at most 3 bits differ in
at most 3 bytes, so they share at least 5 of their 8 positional bytes: the guaranteed
minimum of the count filter. Posting single bytes would give lists of a 256th of all
rows, so positions are posted four at a time, by the 14 blocks of the Steiner system
S(3,4,8): every 5 of 8 positions contain at least one block whole, so each linked pair
meets in a list, and lists stay short (a 2**32nd of the rows by chance). In a list,
shared positional bytes are tallied per pair, pairs with fewer than 5 are discarded,
and the rest verified by Hamming distance. Equal fingerprints are one posting. Lists
are joined in bounded blocks (blocks.py), but for pairs that links already connect, and only
a spanning forest of their links leaves a block; connected components then give the classes, losing no link's effect.

Defined results: null text or no word has fingerprint zero and links like any other;
null ids have their own rows and the class of their fingerprint; an empty table gives
no rows; other columns pass through ``near_duplicates`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut
from .blocks import BLOCK, forest, groups_of, spanning
from .common import small_batches, text_bytes

SHINGLE = 3
SEED = 42
BITS = 3
#: Blocks of the Steiner system S(3,4,8): any 5 of the 8 byte positions hold one of them.
POSITIONS = tuple((a, b, c, d) for a in range(8) for b in range(a + 1, 8) for c in range(b + 1, 8) for d in range(c + 1, 8) if a ^ b ^ c ^ d == 0)


def shingle_hashes(text: bytes, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased (A-Z) words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hashed(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    return np.fromiter((hashed(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(starts))


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half of the hashes; 0 without words."""
    h = shingle_hashes(text or b"", width, seed)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, width, seed) for t in text_bytes(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Tally of zero bytes in each XOR: a byte's top bit ends up set only where the byte is zero."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return np.bitwise_count(~(((x & low) + low) | x | low))


def _links(rows: dict[str, np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the rows of each list, as pairs of fingerprints."""
    need = 8 - bits
    fps, out_a, out_b = rows["fp"].view(np.uint64), [], []
    for lo, hi in groups_of(rows["group_"]):
        f = fps[lo:hi]
        mine, i, j = rows["mine_"][lo:hi], rows["i_"][lo], rows["j_"][lo]
        left, right = (np.arange(hi - lo), np.arange(hi - lo)) if i == j else (np.flatnonzero(mine == i), np.flatnonzero(mine == j))
        found_a, found_b = [], []
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            x = f[part][:, None] ^ f[right][None, :]
            p, q = np.nonzero(shared_bytes(x) >= need)
            near = np.bitwise_count(x[p, q]) <= bits
            p, q = p[near], q[near]
            found_a.append(part[p])
            found_b.append(right[q])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        for r, n in forest(hi - lo, a[a != b], b[a != b]):
            out_a.append(f[r])
            out_b.append(f[n])
    return np.array(out_a, np.uint64).view(np.int64), np.array(out_b, np.uint64).view(np.int64)


def fingerprint_links(distinct: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``: links among distinct fingerprints ``fp`` that connect every pair within ``bits``."""
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    packed = lambda ps: sum((F.shiftleft(byte(p), 8 * n) for n, p in enumerate(ps)), F.lit(0).cast("long"))
    lists = [F.struct(F.lit(k).alias("k"), packed(ps).alias("v")) for k, ps in enumerate(POSITIONS)]
    posts = distinct.select("fp", F.explode(F.array(*lists)).alias("p")).select("fp", F.col("p.k").alias("k"), F.col("p.v").alias("v"))

    def work(rows):
        a, b = _links(rows, bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return spanning(posts, ["k", "v"], "fp", work, "long", ["fp"], block)


def near_duplicates(docs: DataFrame, bits: int = BITS, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id of the class) for every row of docs."""
    prints = cut(fingerprints(docs, width, seed))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comps = connected_components(fingerprint_links(distinct.select("fp"), bits), "a", "b")
    joined = distinct.join(comps, distinct["fp"] == comps["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("class"))
    lows = joined.groupBy("class").agg(F.min("low").alias("component_id"))
    classes = joined.join(lows, "class").select("fp", "class", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "class", "component_id")


def hex_fingerprint(fp):
    """16 lowercase hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
