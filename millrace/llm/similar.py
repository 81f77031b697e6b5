"""Near-duplicate documents at a given shingle similarity, by a long SimHash (operator 2's stage form).

The 64-bit fingerprint of the contract tells copies within 3 bits; a similarity of 0.8 on
five-word shingles moves about 10 of 64 bits, so this form uses BITS bits, whose distance
estimates the similarity within 0.03. The steps are operator 2's: an inverted index of
positional bytes, a tally of shared bytes with a minimum, the Hamming distance;
an exact check follows.

Bytes are posted two at a time, all pairs within each of 11 groups of the 64 positions: two
texts meet unless no group holds two of the bytes that they share, so any 12 shared bytes
meet. At similarity 0.8 texts share about 17, and meet with a chance of 0.999 (0.997 measured
at the worst sizes), at every size of table. Fingerprints of few shingles are rougher: sets of up
to SHORT post all pairs within 4 groups, the same ones and more. A posting carries the
number of shingles and 128 bits of the fingerprint from other bytes than its own; rows of a
list whose sizes and carried bits are near are candidates. In lists of more than LIST rows
each meets the next WINDOW rows so; rows that this leaves outside the component of most of
the list then meet that component by whole fingerprints, in bounded blocks, once for all
lists. Only spanning forests are told.

Pairs of a connected class of candidates then go through the tally of shared bytes (fewer
than MIN_SHARED go), the Hamming distance (estimates more than MARGIN below the limit go)
and exact Jaccard similarity of their sets of shingle hashes, in bounded blocks, but for
pairs that verified links already connect; only verified pairs link.

Defined results: texts without any word (null, empty, blank) are one class; the row of the
smallest doc_id stays, one with an id before one without; rows alike in id and text are
repeated rows, of which that with the smallest hash of its other columns stays; an empty
table gives no rows; every column of docs comes back as it was.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut, release
from .blocks import BLOCK, beside_components, forest, groups_of, merged, spanning
from .common import row_hash, small_batches, text_bytes, whole

SHINGLE = 5
SIMILARITY = 0.8
BITS = 512
#: Pairs estimated at least so much below the limit are left out: over three standard errors.
MARGIN = 0.15
#: Least shared bytes of 64; at the limit fewer have a chance of 0.00003 (sets of 4 and 5: 0.001).
MIN_SHARED = 4
#: Sets of up to so many shingles post more pairs of bytes; the estimate says too little of a set below ROUGH.
SHORT = 5
ROUGH = 16
#: Rows of a list whose pairs are compared where it is sorted; rows of a longer list that a row meets there; rows worked on at once.
LIST = 4096
WINDOW = 256
ROWS = 1 << 17
#: Bytes of shingle sets in a unit of exact checks.
SET_BYTES = 16 << 20
SEED = 42
_MIX = [(0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64) | 1 for k in range(BITS // 64)]


def _position_pairs() -> tuple[np.ndarray, int]:
    """Pairs of byte positions within the quarters of a fingerprint, and how many come first: those within smaller groups, three or two to a quarter."""
    groups = [range(16 * q + a, 16 * q + b) for q in range(4) for a, b in (((0, 5), (5, 10), (10, 16)) if q < 3 else ((0, 8), (8, 16)))]
    few = [(a, b) for g in groups for a in g for b in g if a < b]
    every = [(a, b) for q in range(4) for a in range(16 * q, 16 * q + 16) for b in range(a + 1, 16 * q + 16)]
    return np.array(few + sorted(set(every) - set(few))), len(few)


PAIRS, FEW = _position_pairs()
#: Bits of a posting's key below its list: the number of shingles.
SIZE_BITS = 38


def long_fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> tuple[bytes, int]:
    """BITS bits, each set in over half of the distinct shingle hashes' words, and their number. No word: zeros and 0."""
    h = shingle_set(text, width, seed)
    return fingerprint_of(h), len(h)


def shingle_set(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words; a shorter text is one shingle. No word: none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) <= width:
        h = np.array([hashed(joined, seed)], np.uint64)
    else:
        starts = np.concatenate(([0], ends[:-width])).tolist()
        h = np.fromiter((hashed(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(starts))
    return np.unique(h)


def fingerprint_of(h: np.ndarray) -> bytes:
    """The long fingerprint of a set of shingle hashes."""
    if not len(h):
        return bytes(BITS // 8)
    out = bytearray()
    for m in _MIX:
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 4096):
            x = (h[at : at + 4096] ^ np.uint64(m >> 7)) * np.uint64(m)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
            ones += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
        out += np.packbits(2 * ones > len(h)).tobytes()
    return bytes(out)


def similarity(apart: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from differing bits and the two numbers of shingles."""
    cosine = np.cos(np.pi * np.minimum(apart / BITS, 0.5))
    both = np.minimum(cosine * np.sqrt(n_a * n_b), np.minimum(n_a, n_b))
    return both / np.maximum(n_a + n_b - both, 1e-9)


def bands(h: np.ndarray) -> np.ndarray:
    """The lists that a set of shingle hashes is posted to."""
    return lists_of(np.frombuffer(fingerprint_of(h), np.uint8)[None, :], len(PAIRS) if len(h) <= SHORT else FEW)[0]


def lists_of(fp: np.ndarray, pairs: int) -> np.ndarray:
    """The list of each fingerprint (a row of bytes) for each of the first ``pairs`` of positions: the pair's number and the two bytes."""
    a, b = PAIRS[:pairs].T
    return np.arange(pairs) << 16 | fp[:, a].astype(np.int64) << 8 | fp[:, b]


def apart_limit(least: float, bits: int = BITS) -> float:
    """Differing bits that a similarity of ``least`` moves."""
    return bits * math.acos(2 * least / (1 + least)) / math.pi


def shared_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tally of equal positional bytes of fingerprints, row by row."""
    return (x.view(np.uint8) == y.view(np.uint8)).sum(axis=-1)


def plausible(x: np.ndarray, y: np.ndarray, apart: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, least: float) -> np.ndarray:
    """Whether pairs of fingerprints share MIN_SHARED bytes and their distance allows a similarity of ``least``; that of sets below ROUGH is rough and may be 24 bits more."""
    near = (apart <= apart_limit(least) + 1) & (similarity(apart, n_x, n_y) >= least)
    near |= (np.minimum(n_x, n_y) < ROUGH) & (apart <= apart_limit(least) + 25)
    return (shared_bytes(x, y) >= MIN_SHARED) & near


def _postings(batches):
    """key (list and number of shingles), id and the carried bits of each posting of rows (id, fp, n)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = np.frombuffer(b"".join(text_bytes(batch.column(1))), np.int64).reshape(batch.num_rows, -1)
        fp, ids, n = words.view(np.uint8), batch.column(0).to_numpy(), batch.column(2).to_numpy()
        for rows, pairs in ((np.flatnonzero(n > SHORT), FEW), (np.flatnonzero(n <= SHORT), len(PAIRS))):
            # Pairs of the last quarter carry the first quarter's bits, the others the last one's.
            other = (PAIRS[:pairs, 0] >= 48)[None, :]
            for at in range(0, len(rows), 256):
                r = rows[at : at + 256]
                key = lists_of(fp[r], pairs) << SIZE_BITS | np.minimum(n[r], (1 << SIZE_BITS) - 1)[:, None]
                carried = [np.where(other, words[r, w][:, None], words[r, 6 + w][:, None]).ravel() for w in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.ravel(), np.repeat(ids[r], pairs), *carried)], ["key", "id", "x", "y"])


def near_in_lists(key: np.ndarray, ids: np.ndarray, x: np.ndarray, y: np.ndarray, far: np.ndarray, least: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect the rows (sorted by key) of the same list whose sizes allow a similarity of ``least`` and whose carried bits are near.

    A row marked ``far`` meets the next ``window`` rows of its list only.
    """
    lists, size = key >> SIZE_BITS, key & ((1 << SIZE_BITS) - 1)
    x, y = x.view(np.uint64), y.view(np.uint64)
    nodes, code = np.unique(ids, return_inverse=True)
    # Four standard errors above what the limit moves; more bits where few shingles make them rougher.
    most = apart_limit(least, 128) + 9
    root, held, n_held, d = np.arange(len(nodes)), [], 0, 1
    at = np.flatnonzero(lists[1:] == lists[:-1])
    while len(at):
        at = at[size[at + d] * least <= size[at]]
        if d > window:
            at = at[~far[at]]
        new = at[root[code[at]] != root[code[at + d]]]
        apart = np.bitwise_count(x[new] ^ x[new + d]) + np.bitwise_count(y[new] ^ y[new + d])
        near = new[apart <= np.where(size[new] <= SHORT, most + 4, most)]
        held.append((code[near], code[near + d]))
        n_held += len(near)
        if n_held > 4096:
            root, held, n_held = merged(root, *map(np.concatenate, zip(*held))), [], 0
        d += 1
        at = at[at + d < len(key)]
        at = at[lists[at + d] == lists[at]]
    if held:
        root = merged(root, *map(np.concatenate, zip(*held)))
    ends = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[ends]], nodes[ends]


def _meet(least: float, most: int = LIST, window: int = WINDOW):
    """Over postings sorted by key: links a, b that connect the near rows of whole lists. Lists of more than ``most`` rows are only linked within a window; their rows come back as a and their list."""

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        long_list = -1

        def emit(rows, last: bool):
            nonlocal long_list, held
            lists = rows[0] >> SIZE_BITS
            starts = np.concatenate(([0], np.flatnonzero(lists[1:] != lists[:-1]) + 1))
            lengths = np.diff(np.append(starts, len(lists)))
            is_long = (lengths > most) | (lists[starts] == long_list)
            stop = len(lists)
            if is_long[-1]:
                long_list = lists[-1]
            elif not last:
                stop = starts[-1]
            held = [tuple(c[stop:] for c in rows)] if stop < len(lists) else []
            far = np.repeat(is_long, lengths)[:stop]
            key, ids, x, y = (c[:stop] for c in rows)
            if far.any():
                out = pa.array(ids[far])
                yield pa.RecordBatch.from_arrays([out, pa.nulls(len(out), pa.int64()), pa.array(lists[:stop][far])], ["a", "b", "list"])
            a, b = near_in_lists(key, ids, x, y, far, least, window)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "list"])

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(i).to_numpy() for i in range(4)))
            if sum(len(h[0]) for h in held) >= ROWS:
                yield from emit(tuple(map(np.concatenate, zip(*held))), False)
        if held:
            yield from emit(tuple(map(np.concatenate, zip(*held))), True)

    return run


def candidates(distinct: DataFrame, least: float, block: int = BLOCK, most: int = LIST, window: int = WINDOW) -> DataFrame:
    """a, b: links that connect the pairs that the index finds near a similarity of ``least``, of rows (id, fp, n)."""
    rows = distinct.select("id", "fp", F.col("n").cast("long").alias("size"))
    posts = rows.mapInArrow(_postings, "key long, id long, x long, y long")
    by_list = posts.repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key")
    met = cut(by_list.mapInArrow(_meet(least, most, window), "a long, b long, list long"))
    found = met.filter("b is not null").select("a", "b")
    long_lists = met.filter("b is null").select("list", F.col("a").alias("id"))
    if long_lists.isEmpty():
        return found
    apart_most = apart_limit(least) + 1

    def work(rows):
        out_a, out_b = [], []
        for lo, hi in groups_of(rows["group_"]):
            fp = np.frombuffer(b"".join(rows["fp"][lo:hi]), np.uint64).reshape(hi - lo, -1)
            ids, size, mine = rows["id"][lo:hi], rows["size"][lo:hi].astype(float), rows["mine_"][lo:hi]
            i, j = rows["i_"][lo], rows["j_"][lo]
            every = np.arange(hi - lo)
            left, right = (every, every) if i == j else (np.flatnonzero(mine == i), np.flatnonzero(mine == j))
            all_a, all_b = [], []
            for at in range(0, len(left), 256):
                a = left[at : at + 256]
                apart = sum(np.bitwise_count(fp[a, w][:, None] ^ fp[right, w][None, :]).astype(np.int32) for w in range(fp.shape[1]))
                p, q = np.nonzero(apart <= apart_most + 24)
                x, y = a[p], right[q]
                ok = (x < y) if i == j else np.ones(len(x), bool)
                x, y, apart = x[ok], y[ok], apart[p[ok], q[ok]]
                for s in range(0, len(x), 65_536):
                    u, v = x[s : s + 65_536], y[s : s + 65_536]
                    good = plausible(fp[u], fp[v], apart[s : s + 65_536], size[u], size[v], least)
                    all_a.append(u[good])
                    all_b.append(v[good])
            if all_a:
                for r, k in forest(hi - lo, np.concatenate(all_a), np.concatenate(all_b)):
                    out_a.append(int(ids[r]))
                    out_b.append(int(ids[k]))
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return found.unionAll(beside_components(long_lists, found, rows, work, ["id", "fp", "size"], block))


def matching(sets: list[np.ndarray], fp: np.ndarray, left: np.ndarray, right: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs (one of left, one of right) with exact Jaccard similarity of at least ``least``; pairs that these already connect are left out.

    A pair whose sizes, shared bytes or distance rule it out is not counted; the others' shared hashes are counted, a row of left at a time.
    """
    size = np.array([len(x) for x in sets])
    starts = np.concatenate(([0], np.cumsum(size)))
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(len(code) + 1, bool)
    root, out = np.arange(len(sets)), []
    for a in left.tolist():
        b = right[(right != a) & (root[right] != root[a])]
        b = b[np.minimum(size[b], size[a]) >= least * np.maximum(size[b], size[a]) - 1e-9]
        if len(b):
            b = b[plausible(fp[b], fp[a], np.bitwise_count(fp[b] ^ fp[a]).sum(axis=1, dtype=np.int64), size[b], size[a], least - MARGIN)]
        if not len(b):
            continue
        own = code[starts[a] : starts[a + 1]]
        mark[own] = True
        both = np.array([np.count_nonzero(mark[code[starts[k] : starts[k + 1]]]) for k in b.tolist()])
        mark[own] = False
        for k in b[both >= least * (size[a] + size[b] - both) - 1e-9].tolist():
            if root[k] != root[a]:
                out.append((a, k))
                root[root == root[k]] = root[a]
    return out


def links(rows: DataFrame, least: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """a, b: links that connect the pairs with exact similarity of at least ``least`` within each class of candidates.

    Rows are (node, component, fp, set). Every pair of a class that other links do not connect is checked, in blocks bounded in rows and bytes.
    """

    def work(rows):
        out_a, out_b = [], []
        for lo, hi in groups_of(rows["group_"]):
            sets = [np.frombuffer(x, np.uint64) for x in rows["set"][lo:hi]]
            fp = np.frombuffer(b"".join(rows["fp"][lo:hi]), np.uint64).reshape(hi - lo, -1)
            ids, mine, i, j = rows["node"][lo:hi], rows["mine_"][lo:hi], rows["i_"][lo], rows["j_"][lo]
            for a, b in matching(sets, fp, np.flatnonzero(mine == i), np.flatnonzero(mine == j), least):
                out_a.append(int(ids[a]))
                out_b.append(int(ids[b]))
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return spanning(rows, ["component"], "node", work, "long", ["node", "set", "fp"], block, F.length("set"), SET_BYTES, 2 * SET_BYTES)


def keep_one(docs: DataFrame, least: float = SIMILARITY, width: int = SHINGLE) -> DataFrame:
    """Rows of docs, one of each class of near-duplicates: that with the smallest doc_id, then checksum.

    Texts without any word are one class. Classes are found on slim rows; the texts are
    shuffled once, against the winners' keys. Postings, sets and texts are each the size of the
    input or more; the shuffle files of each are dropped before the next.
    """
    key = lambda: F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))).cast("binary"))
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in text_bytes(batch.column(2))]
            fp = [fingerprint_of(h) for h in sets]
            sig = [xxhash.xxh3_128_digest(h.tobytes()) for h in sets]
            columns = [pa.array(sig, pa.binary()), pa.array(fp, pa.binary()), pa.array([len(h) for h in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["k", "doc_id", "sig", "fp", "n"])

    def sets_of(batches):
        for batch in batches:
            sets = [shingle_set(t, width) for t in text_bytes(batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([h.tobytes() for h in sets], pa.binary())], ["node", "component", "fp", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = docs.select(key().alias("k"), "doc_id", "text").mapInArrow(run, f"k string, doc_id {kind}, sig binary, fp binary, n long")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("k").alias("k"))).alias("best")
    distinct = cut(prints.groupBy("sig", "n").agg(best, F.first("fp").alias("fp")).withColumn("id", F.xxhash64("sig", "n")))
    near = connected_components(candidates(distinct.filter("n > 0"), least - MARGIN), "a", "b")
    release(docs.sparkSession)
    # Only texts with a candidate are read again for their sets.
    again = near.join(distinct, near["node"] == distinct["id"]).select("node", "component", "fp", F.col("best.k").alias("k_"))
    texts = docs.select(key().alias("k_"), "text").join(again, "k_").select("node", "component", "fp", "text").mapInArrow(sets_of, "node long, component long, fp binary, set binary")
    sets = cut(texts.dropDuplicates(["node"]))
    release(docs.sparkSession)
    comps = connected_components(links(sets, least), "a", "b")
    release(docs.sparkSession)
    classes = distinct.join(comps, distinct["id"] == comps["node"], "left").select(F.coalesce("component", distinct["id"]).alias("class"), "best")
    winners = classes.groupBy("class").agg(F.min("best").alias("best")).select(F.col("best.k").alias("k_"))
    # Repeated rows meet before the shuffle, so that many of them are no single task's.
    rows = docs.select(key().alias("k_"), F.struct(row_hash(docs, ("text",)).alias("h"), whole(docs).alias("row")).alias("r"))
    once = rows.groupBy("k_").agg(F.min_by("r.row", "r.h").alias("row"))
    return once.join(winners, "k_", "left_semi").select("row.*")
