"""SimHash against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import xxhash

from millrace.llm import blocks, simhash


def test_blocks_hold_any_five_positions():
    assert len(simhash.POSITIONS) == 14
    assert all(any(set(p) <= set(c) for p in simhash.POSITIONS) for c in combinations(range(8), 5))


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)) if h else 0


def plain_classes(prints):
    a = np.array(prints, np.uint64)
    n = len(a)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ a[None]) <= 3)):
        x, y = find(i), find(j)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_fingerprints():
    rng = random.Random(3)
    texts = ["", None, "One", "two WORDS", "A b c\x1cd é É", "x " * 5000] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    assert all(simhash.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t) for t in texts)


def test_classes_of_texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows) * 3, " ".join(t)))
    rng.shuffle(rows)
    rows.sort()
    want = plain_classes([plain_fingerprint(t) for _, t in rows])
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == [rows[w][0] for w in want]


def test_chains_in_lists_of_many_chunks(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    prints = set()
    for b in base.tolist():  # dense walks: neighbours 1 to 3 bits apart
        x = b
        for _ in range(120):
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            prints.add(x)
    fps = sorted(prints | {int(v) for v in rng.integers(0, 2**63, 200, dtype=np.uint64)})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    at = {int(np.uint64(f).astype(np.int64)): i for i, f in enumerate(fps)}
    for block in (4, 2048):
        root = list(range(len(fps)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for r in simhash.fingerprint_links(df, block=block).collect():
            x, y = find(at[r["a"]]), find(at[r["b"]])
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(fps))] == plain_classes(fps)


def test_units_meet_every_pair_once(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    u = blocks.units(df, ["k"], F.xxhash64("id"), block=7)
    rows = u.select("k", "i_", "j_", "mine_", "id").collect()
    by = {}
    for r in rows:
        by.setdefault((r["k"], r["i_"], r["j_"]), []).append((r["mine_"], r["id"]))
    seen = []
    for (k, i, j), members in by.items():
        left = [x for m, x in members if m == i]
        right = [x for m, x in members if m == j]
        seen += [frozenset(p) for p in (combinations(left, 2) if i == j else ((a, b) for a in left for b in right))]
    want = [frozenset(p) for p in combinations(range(100), 2) if min(p) % 3 == max(p) % 3]
    assert len(seen) == len(want) and set(seen) == set(want)
