"""The stage form of near-duplicate removal against exact shingle similarity."""

import random
import time

import numpy as np
import pyarrow as pa

from millrace.llm import similar


def shingles(text):
    w = text.lower().split()
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_estimate():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    off = []
    for _ in range(60):
        a = [rng.choice(words) for _ in range(200)]
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            b[rng.randrange(200)] = rng.choice(words)
        (fa, na), (fb, nb) = (similar.long_fingerprint(" ".join(x).encode()) for x in (a, b))
        apart = sum(bin(x ^ y).count("1") for x, y in zip(fa, fb))
        off.append(float(similar.similarity(np.array([apart]), np.array([na]), np.array([nb]))[0]) - jaccard(" ".join(a), " ".join(b)))
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.13


def test_keeps_one_of_each_class(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    rows, keep = [], set()
    for g in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(120, 260))]
        keep.add(len(rows))
        for k in range(rng.choice([1, 1, 3, 30 if g == 0 else 2])):
            t = list(base)
            for _ in range(k and rng.randint(0, 1)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows), " ".join(t).upper() if k % 2 else " ".join(t), g))
        far = list(base)
        for at in range(0, len(far), 12):
            far[at] = "other"
        keep.add(len(rows))
        rows.append((len(rows), " ".join(far), g))
    keep |= {len(rows), len(rows) + 2}
    rows += [(len(rows), "", 0), (len(rows) + 1, None, 0), (len(rows) + 2, "short text", 0), (len(rows) + 3, "short  TEXT", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int").repartition(5)
    got = similar.keep_one(docs)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == keep
    assert similar.keep_one(docs.limit(0)).count() == 0


def test_repeated_line_and_short_texts_are_verified(spark):
    rng = random.Random(7)
    line = " ".join(f"common{i}" for i in range(12))
    rows = []
    for _ in range(6):
        rows.append(" ".join(f"v{rng.randrange(10**6)}" for _ in range(200)) + "\n" + "\n".join([line] * 20))
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(10 + g % 3)]
        rows += [" ".join(base), " ".join([*base[:-1], "last"])]
    assert max(jaccard(a, b) for k, a in enumerate(rows) for b in rows[:k]) < 0.8
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert similar.keep_one(docs).count() == len(rows)


def test_matching_is_exact():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(8):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.randint(0, 7)):
                t[rng.randrange(150)] = rng.choice(words)
            texts.append(" ".join(t))
    sets = [similar.shingle_set(t.encode()) for t in texts]
    fp = np.frombuffer(b"".join(map(similar.fingerprint_of, sets)), np.uint64).reshape(len(sets), -1)
    every = np.arange(len(texts))

    def classes(pairs):
        root = list(range(len(texts)))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return {frozenset(k for k in every if root[k] == r) for r in root}

    true = [(a, b) for a in every for b in every[:a] if jaccard(texts[a], texts[b]) >= 0.8]
    assert classes(similar.matching(sets, fp, every, every)) == classes(true)


def plain_classes(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        x, y = root[a], root[b]
        root = [x if r == y else r for r in root]
    return {frozenset(k for k in range(n) if root[k] == r) for r in root}


def test_hot_class_links_as_all_pairs_do(spark):
    # One candidate class in chunks of 16: a dense group, a sparse one, chains between and rows apart.
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size, edits in ((90, 2), (25, 9), (20, 14)):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(150)] = rng.choice(words)
            texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words) for _ in range(150)) for _ in range(15)]
    sets = [similar.shingle_set(t.encode()) for t in texts]
    rows = [(k, 0, bytearray(similar.fingerprint_of(h)), bytearray(h.tobytes())) for k, h in enumerate(sets)]
    true = [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    df = spark.createDataFrame(rows, "node long, component long, fp binary, set binary")
    for block in (16, 2048):
        got = similar.links(df, block=block).collect()
        assert plain_classes(len(texts), [(r["a"], r["b"]) for r in got]) == plain_classes(len(texts), true)


def test_hot_list_is_compared_in_proportion_to_its_rows(spark):
    # Work counts the rows of its units: a list of like rows meets its leaders only, other rows meet all.
    import pyarrow as pa
    from pyspark.sql import functions as F

    from millrace.llm import blocks

    def work(rows):
        for lo, hi in blocks.groups_of(rows["group_"]):
            like = [int(x) for x in rows["id"][lo:hi] if x % 500]
            met = [(min(like), x) for x in like[:] if x != min(like)] if like else []
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in met] + [-1], pa.int64()), pa.array([b for _, b in met] + [-2 - (hi - lo)], pa.int64())], ["a", "b"])

    seen = {}
    for n in (2000, 8000):
        posts = spark.range(n).select(F.lit(1).alias("key"), "id")
        got = blocks.spanning(posts, ["key"], "id", work, "long", ["id"], block=100).collect()
        seen[n] = sum(-2 - r["b"] for r in got if r["a"] == -1)
        assert plain_classes(n, []) and len({r["b"] for r in got if r["a"] >= 0} | {r["a"] for r in got if r["a"] >= 0}) == n - n // 500
    assert seen[8000] < 6 * seen[2000]


def test_pairs_at_the_limit_meet():
    # 180 of 224 hashes are shared, a similarity of 0.804: a pair meets with a chance of 0.998.
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(500):
        h = rng.integers(0, np.iinfo(np.uint64).max, 224, np.uint64)
        met += bool((similar.bands(np.sort(h[:202])) == similar.bands(np.sort(h[22:]))).any())
    assert met >= 0.98 * 500


def flipped(rng, fp, bits):
    x = np.unpackbits(fp)
    x[rng.choice(len(x), bits, replace=False)] ^= 1
    return np.packbits(x)


def test_twelve_shared_bytes_always_meet():
    rng = np.random.default_rng(6)
    for pairs, shared in ((similar.FEW, 12), (len(similar.PAIRS), 5)):
        for _ in range(300):
            a = rng.integers(0, 256, 64, np.uint8)
            b = a ^ rng.integers(1, 256, 64, np.uint8)
            at = rng.choice(64, shared, replace=False)
            b[at] = a[at]
            assert (similar.lists_of(a[None, :], pairs) == similar.lists_of(b[None, :], pairs)).any()


def test_candidates_come_from_shared_bytes_and_distance(spark):
    # Equal other keys do not make a pair, different ones do not part one: rows 0 and 1 share bytes, rows 2 and 3 are as near but share two bytes only.
    rng = np.random.default_rng(9)
    a, c = (rng.integers(0, 256, 64, np.uint8) for _ in range(2))
    apart = np.where(np.arange(64) < 62, 1, 0).astype(np.uint8)
    rows = [(0, a, 0), (1, flipped(rng, a, 77), 1), (2, c, 2), (3, c ^ apart, 2)]
    df = spark.createDataFrame([(k, bytearray(f.tobytes()), 200, [key] * 16) for k, f, key in rows], "id long, fp binary, n long, keys array<long>")
    for most in (4096, 1):  # lists compared where they are sorted, and long ones
        got = {(r["a"], r["b"]) for r in similar.candidates(df, similar.SIMILARITY - similar.MARGIN, most=most).collect()}
        assert (0, 1) in {(min(x), max(x)) for x in got} and not [x for x in got if {2, 3} & set(x) and {0, 1} & set(x)]
    sets = [np.arange(200, dtype=np.uint64)] * 2
    every = np.arange(2)
    assert similar.matching(sets, np.stack([a, rows[1][1]]).view(np.uint64), every, every) == [(0, 1)]
    assert similar.matching(sets, np.stack([c, c ^ apart]).view(np.uint64), every, every) == []


def test_pairs_at_the_limit_pass_every_step():
    # Sets of a and b hashes that share c, a similarity of 0.8 or a little more: the smallest ones, the worst sizes, and larger ones.
    rng = np.random.default_rng(12)
    for a, b, c, least in ((4, 5, 4, 0.96), (5, 6, 5, 0.98), (13, 14, 12, 0.98), (22, 23, 20, 0.98), (90, 90, 80, 0.99), (400, 500, 400, 0.99)):
        passed = 0
        for _ in range(400):
            h = rng.integers(0, np.iinfo(np.uint64).max, a + b - c, np.uint64)
            sets = [np.sort(h[:a]), np.sort(h[a - c :])]
            fp = np.stack([np.frombuffer(similar.fingerprint_of(x), np.uint8) for x in sets])
            batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([f.tobytes() for f in fp], pa.binary()), pa.array([a, b])], ["id", "fp", "n"])
            posts = pa.Table.from_batches(similar._postings([batch])).sort_by("key").combine_chunks().to_batches()
            met = sum(len(x) for x in similar._meet(similar.SIMILARITY - similar.MARGIN)(posts))
            passed += bool(met and similar.matching(sets, fp.view(np.uint64), np.arange(2), np.arange(2)))
        assert passed >= least * 400, (a, b, passed)


def test_lists_split_over_batches_lose_no_pair(monkeypatch):
    rng = np.random.default_rng(13)
    base = [rng.integers(0, 256, 64, np.uint8) for _ in range(30)]
    fp = [flipped(rng, base[k % 30], int(rng.integers(0, 40))) for k in range(150)] + [flipped(rng, base[0], 5) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(fp))), pa.array([f.tobytes() for f in fp], pa.binary()), pa.array([100 + k % 3 for k in range(len(fp))])], ["id", "fp", "n"])
    posts = pa.Table.from_batches(similar._postings([batch])).sort_by("key").combine_chunks()

    def run(size, most):
        out = [r for x in similar._meet(0.65, most)(posts.to_batches(max_chunksize=size)) for r in x.to_pylist()]
        return plain_classes(len(fp), [(r["a"], r["b"]) for r in out if r["b"] is not None]), sorted((r["list"], r["a"]) for r in out if r["b"] is None)

    whole, none = run(1 << 20, 512)
    assert none == [] and len(whole) == 30
    lists = run(1 << 20, 20)[1]
    assert lists
    monkeypatch.setattr(similar, "ROWS", 64)
    assert run(16, 512) == (whole, []) and run(16, 20)[1] == lists


def test_long_lists_meet_as_short_ones_do(spark):
    rng = np.random.default_rng(14)
    base = [rng.integers(0, 256, 64, np.uint8) for _ in range(12)]
    fp = [flipped(rng, base[0 if k < 80 else k % 12], int(rng.integers(0, 50))) for k in range(140)]
    df = spark.createDataFrame([(k, bytearray(f.tobytes()), 100) for k, f in enumerate(fp)], "id long, fp binary, n long")
    classes = [plain_classes(len(fp), [(r["a"], r["b"]) for r in similar.candidates(df, 0.65, block=16, most=most, window=1).collect()]) for most in (4096, 8)]
    assert classes[0] == classes[1] and len(classes[0]) == 12


def test_postings_leave_the_disk_before_links(spark, monkeypatch):
    rng = random.Random(15)
    docs = spark.createDataFrame([(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(14))) for k in range(1500)], "doc_id long, text string")
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_")}

    before, most, left, links = shuffles(), 1500 * similar.FEW * 8, [], similar.links

    def seen(*args):
        for _ in range(20):  # the cleaner runs beside the driver
            left.append(sum(n for name, n in shuffles().items() if name not in before))
            if left[-1] < most / 2:
                break
            time.sleep(0.25)
        return links(*args)

    monkeypatch.setattr(similar, "links", seen)
    assert similar.keep_one(docs).count() == 1500
    assert left[-1] < most / 2, left
