"""Best-fit packing by exact-complement hashing (operator 8).

Documents become token ids (a closing id 0 each); only those longer than a sequence
are cut. The lengths' histogram, at most ``capacity`` rows whatever the input, is all
that reaches the driver. There a plan is made on counts: for each length, longest
first, an index of single, pair and triple sums yields combinations that fill the gap
exactly, each consumed as often as the counts allow; what remains goes best-fit. A
piece's rank within its length (two-level prefix counts: a length is dealt into cells in
proportion to its pieces, so no task holds a whole length) then picks its place in the plan.

Defined results: null or empty text is the closing id alone; bytes that are no UTF-8 count as
replacement characters; ids of any type, null ids, repeated rows
and ties are packed like any row; an empty table gives no rows; other columns are not
read. The plan depends on the counts only, so reruns agree.
"""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import per_process, small_batches, text_bytes

CAPACITY = 2048
#: Chunks kept by a worker; rarer ones are encoded again.
CACHE_ROWS = 900_000
#: Pieces of one length are ranked in cells of about so many.
CELL_ROWS = 4_096

PIECES = "piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkIds(dict):
    """Little-endian ids by white-space separated chunk, exactly as the whole text encodes.

    The tokenizer drops white space, and its normaliser and splitter never look across
    it, so a text's ids are its chunks' ids in a row. Chunks of letters with a final
    comma or full stop, and capitals, fall back to the plain word.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words: dict[bytes, bytes] = {}
        self.marks = {m: self._encode(m.decode()) for m in (b".", b",")}

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes | None:
        """Ids of an all-letter chunk, or None if it has to go through the whole tokenizer."""
        if word.isalpha():  # ASCII letters
            low = word.lower()
            found = self.words.get(low)
            if found is None:
                found = np.asarray([t.id for t in self.model.tokenize(low.decode())], "<u4").tobytes()
                if len(self.words) < CACHE_ROWS:
                    self.words[low] = found
            return found
        text = word.decode("utf-8", "replace")
        if not text.isalpha() or "Σ" in text or "İ" in text or not unicodedata.is_normalized("NFC", text):
            return None
        low = text.lower().encode()
        found = self.words.get(low)
        if found is None:
            found = self._encode(text)
            if len(self.words) < CACHE_ROWS:
                self.words[low] = found
        return found

    def __missing__(self, chunk: bytes) -> bytes:
        mark = self.marks.get(chunk[-1:])
        ids = self._word(chunk[:-1]) if mark and len(chunk) > 1 else self._word(chunk)
        if ids is None:
            ids = self._encode(chunk.decode("utf-8", "replace"))
        elif mark:
            ids += mark
        if len(self) < CACHE_ROWS and len(chunk) <= 64:
            self[chunk] = ids
        return ids


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)

    def run(batches):
        where = path or tokenizer_path()
        ids_of = per_process(f"chunks:{where}", lambda: ChunkIds(where))
        get, end, wide = ids_of.__getitem__, b"\0\0\0\0", 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in enumerate(text_bytes(batch.column(1))):
                ids = b"".join(map(get, (text or b"").split())) + end
                for k, at in enumerate(range(0, len(ids), wide)):
                    part = ids[at : at + wide]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            which, *cols = (pa.array(c, t) for c, t in zip(cols, types))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(which), *cols], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECES}")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how often each is used; every count is used up exactly."""
    left = [0] * (capacity + 1)
    for size, n in counts.items():
        left[size] += n
    # have: bit L is set while length L is left; back: the same from the other end.
    have = sum(1 << size for size in range(1, capacity + 1) if left[size])
    back = sum(1 << (capacity - size) for size in range(1, capacity + 1) if left[size])
    patterns: list[tuple[tuple[int, ...], int]] = []

    def take(parts: tuple[int, ...]) -> bool:
        """Use the combination as often as the counts allow."""
        nonlocal have, back
        need = {p: parts.count(p) for p in parts}
        n = min(left[p] // k for p, k in need.items())
        if not n:
            return False
        for p, k in need.items():
            left[p] -= n * k
            if not left[p]:
                have &= ~(1 << p)
                back &= ~(1 << (capacity - p))
        patterns.append((parts, n))
        return True

    def pairs(total: int, most: int):
        """Larger halves, at most ``most``, of the pairs in the index with this sum; large first."""
        both = have & (back >> (capacity - total)) & ((1 << (min(most, total - 1) + 1)) - 1)
        both &= ~((1 << ((total + 1) // 2)) - 1)
        while both:
            top = both.bit_length() - 1
            yield top
            both &= ~(1 << top)

    for size in range(capacity, 0, -1):
        gap = capacity - size
        if not left[size]:
            continue
        if not gap:
            take((size,))
            continue
        if gap <= size and left[gap]:
            take((size, gap))
        for a in pairs(gap, size):
            if not left[size]:
                break
            take((size, a, gap - a))
        a_bits = have & ((1 << (min(size, gap - 2) + 1)) - 1) if gap > 2 else 0
        while a_bits and left[size]:
            a = a_bits.bit_length() - 1
            a_bits &= ~(1 << a)
            if 3 * a < gap:
                break
            for b in pairs(gap - a, a):
                if not left[size] or not left[a]:
                    break
                take((size, a, b, gap - a - b))

    # Best fit of the rest, longest first: groups of equal open sequences by their gap.
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    open_bits = 0
    for size in range(capacity, 0, -1):
        n = left[size]
        while n:
            fit = (open_bits >> size) << size
            if fit:
                gap = (fit & -fit).bit_length() - 1
                parts, many = gaps[gap].pop()
                if not gaps[gap]:
                    open_bits &= ~(1 << gap)
                used = min(n, many)
                if many > used:
                    gaps[gap].append((parts, many - used))
                    open_bits |= 1 << gap
            else:
                gap, parts, used = capacity, (), n
                if 2 * size <= capacity:  # close as many whole sequences of this length as there are
                    each = capacity // size
                    used = max(1, n // each)
                    take_each = min(each, n)
                    n -= used * take_each
                    rest = capacity - take_each * size
                    gaps.setdefault(rest, []).append(((size,) * take_each, used))
                    if rest:
                        open_bits |= 1 << rest
                    continue
            n -= used
            rest = gap - size
            gaps.setdefault(rest, []).append((parts + (size,), used))
            if rest:
                open_bits |= 1 << rest
    for groups in gaps.values():
        patterns += groups
    return patterns


def segments(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset) by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for parts, n in patterns:
        offset = 0
        for size in parts:
            rank = used.get(size, 0)
            rows.append((size, rank, sequence, offset))
            used[size] = rank + n
            offset += size
        sequence += n
    return np.asarray(sorted(rows), np.int64).reshape(-1, 4)


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = cut(token_pieces(docs, path, capacity))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = segments(plan(counts, capacity))
    many = F.element_at(F.array(*(F.lit(-(-counts.get(size, 1) // CELL_ROWS)) for size in range(1, capacity + 1))), F.col("length").cast("int"))
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), many).cast("int"))
    cells = pieces.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = cells.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))).select("length", "cell", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32"))).join(before, ["length", "cell"]).withColumn("rank", F.col("rank") + F.col("before") - 1)

    def place(batches):
        size, first, sequence, offset = places.T
        starts = np.searchsorted(size, np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for one in np.unique(length):
                mine = length == one
                a, b = starts[one], starts[one + 1]
                at[mine] = a + np.searchsorted(first[a:b], rank[mine], "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"doc_id {kind}, {PIECES}, sequence_id long, offset long")
