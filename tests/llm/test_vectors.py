"""Embedding near-duplicates and nearest neighbours against brute force."""

import numpy as np
import pytest

from millrace.llm import ann, vectors


def data(seed=1, groups=40, dim=64):
    rng = np.random.default_rng(seed)
    rows, label = [], []
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 9))):
            rows.append(base + rng.normal(size=dim) * rng.uniform(0.0, 0.5))
            label.append(g % 3)
    hot = rng.normal(size=dim)
    rows += [hot] * 30 + [hot + rng.normal(size=dim) * 0.1 for _ in range(40)]
    label += [0] * 70
    x = np.array(rows, np.float32)
    order = rng.permutation(len(x))
    return x[order], np.array(label)[order]


def frame(spark, x, label):
    return spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")


def test_links_equal_brute_force(spark):
    x, label = data()
    y = x.astype(np.float64)
    u = y / np.sqrt((y * y).sum(axis=1, keepdims=True))
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    got = sorted(map(tuple, vectors.near_duplicates(frame(spark, x, label)).collect()))
    found, true = sum(r[1] for r in got), int(link.sum())
    assert found <= true and found >= 0.97 * true
    root = np.arange(len(x))
    for i, j in zip(*np.nonzero(link)):
        a, b = root[i], root[j]
        root[root == max(a, b)] = min(a, b)
    assert np.mean([r[2] == root[r[0]] for r in got]) > 0.97
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_small_blocks_give_the_same(spark, monkeypatch):
    from millrace.llm import blocks

    x, label = data(2)
    df = frame(spark, x, label)
    whole = sorted(map(tuple, vectors.near_duplicates(df).collect()))
    plain = blocks.units
    monkeypatch.setattr(vectors, "units", lambda posts, key, h: plain(posts, key, h, block=5))
    assert sorted(map(tuple, vectors.near_duplicates(df).collect())) == whole


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 64)).astype(np.float32)
    x[100:140] = x[100]
    df = frame(spark, x, np.zeros(len(x), int))
    got = ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect()
    y = x.astype(np.float64)
    u = y / np.sqrt((y * y).sum(axis=1, keepdims=True))
    hits = 0
    for q in range(0, len(x), 50):
        s = u @ u[q]
        s[q] = -2
        best = set(np.lexsort((np.arange(len(x)), -np.round(s, 12)))[:5].tolist())
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(m[2] - s[m[1]]) < 1e-12 for m in mine)
        hits += len(best & {m[1] for m in mine})
    assert hits >= 0.9 * len(got)


def test_footrule():
    order = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5]])
    index = ann.Inverted(order, 6)
    assert index.footrule(np.array([0, 1, 2])).tolist() == [0, 4, 12]


@pytest.mark.parametrize("walked", [0, 512])
def test_shared_pivots_equal_sets(monkeypatch, walked):
    monkeypatch.setattr(vectors, "WALKED", walked)
    rng = np.random.default_rng(4)
    order = np.array([np.concatenate(([7], rng.permutation(np.delete(np.arange(20), 7))[:5])) for _ in range(30)])
    left, right = np.arange(0, 12), np.arange(12, 30)
    for a, b in ((left, right), (np.arange(30), np.arange(30))):
        count, sooner = vectors.shared_pivots(order, 7, a, b)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                both = set(order[x]) & set(order[y])
                assert count[i, j] == len(both) and sooner[i, j] == (min(both) < 7)


def with_hot_group(n, noise, seed=11, dim=64):
    """n vectors, a third of them near copies of one (noise relative to its length)."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    hot = np.arange(n) % 3 == 0
    x[hot] = x[0] + rng.normal(size=(int(hot.sum()), dim)) * noise
    return x.astype(np.float32), hot


def test_links_of_a_hot_near_copy_group(spark):
    x, _ = with_hot_group(3000, 0.15)
    y = x.astype(np.float64)
    u = y / np.sqrt((y * y).sum(axis=1, keepdims=True))
    true = int((u @ u.T >= 0.93).sum()) - len(x)
    found = sum(r["n_links"] for r in vectors.near_duplicates(frame(spark, x, np.zeros(len(x), int))).collect())
    assert 0.99 * true <= found <= true


def test_recall_outside_a_hot_group(spark):
    x, hot = with_hot_group(8000, 0.3)
    df = frame(spark, x, np.zeros(len(x), int))
    got = ann.nearest_neighbours(df, df.filter("vec_id % 50 = 1")).collect()
    y = x.astype(np.float64)
    u = y / np.sqrt((y * y).sum(axis=1, keepdims=True))
    hits = {True: [], False: []}
    for q in range(1, len(x), 50):
        s = u @ u[q]
        s[q] = -2
        mine = {r["vec_id"] for r in got if r["query_id"] == q}
        hits[bool(hot[q])].append(len(set(np.argsort(-s)[:5].tolist()) & mine) / 5)
    assert len(hits[True]) > 40 and len(hits[False]) > 90
    assert np.mean(hits[False]) >= 0.9 and np.mean(hits[True]) >= 0.9, (np.mean(hits[False]), np.mean(hits[True]))


def test_vectors_of_several_lengths(spark):
    """Each length has its own index; lengths that the sample misses are linked and searched all the same."""
    rng = np.random.default_rng(21)
    rows = [rng.normal(size=64) for _ in range(1500)] + [rng.normal(size=16) for _ in range(300)]
    rows += [r + rng.normal(size=len(r)) * 0.05 for r in rows[::9]] + [np.array([1.0, 2.0]), np.array([1.0, 2.01]), np.array([-2.0, 1.0])]
    df = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    want = [0] * len(rows)
    for d in {len(r) for r in rows}:
        at = [i for i, r in enumerate(rows) if len(r) == d]
        u = ann.unit(np.array([rows[i] for i in at]))
        for i, row in zip(at, u @ u.T >= 0.93):
            want[i] = int(row.sum()) - 1
    found = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df).collect()}
    assert [found[i] for i in range(len(rows))] == want and want[-3:] == [1, 1, 0]
    got = ann.nearest_neighbours(df, df.filter("vec_id >= 1500 and vec_id % 50 = 0 or vec_id >= 2000")).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert set(by[2000]) == {2001, 2002} and all(len(rows[q]) == len(rows[v]) for q in by for v in by[q])
    hits = []
    for q in by:
        same = [i for i in range(len(rows)) if len(rows[i]) == len(rows[q]) and i != q]
        score = ann.unit(np.array([rows[i] for i in same])) @ ann.unit(rows[q][None])[0]
        hits.append(np.mean([same[i] in by[q] for i in np.argsort(-score)[:5]]))
    assert np.mean(hits) >= 0.95


def test_search_does_not_depend_on_shards(spark, monkeypatch):
    x = np.random.default_rng(31).normal(size=(3000, 32)).astype(np.float32)
    df = frame(spark, x, np.zeros(len(x), int)).repartition(3)
    whole = sorted(map(tuple, ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect()))
    monkeypatch.setattr(ann, "SHARD", 170)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 9)
    assert sorted(map(tuple, ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect())) == whole


def test_repeated_query_ids_each_count(spark):
    x = np.random.default_rng(33).normal(size=(40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[5].tolist()), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.nearest_neighbours(df, df.filter("vec_id = 0")).collect()]
    u = ann.unit(x)
    want = []
    for q in (0, 5):
        s = u @ u[q]
        near = [i for i in np.argsort(-s) if i != 0][:5]
        want += [(0, k + 1, int(i), round(float(s[i]), 12)) for k, i in enumerate(near)]
    assert sorted((a, b, c, round(d, 12)) for a, b, c, d in got) == sorted(want)


def test_recall_at_256_dimensions(spark):
    rng = np.random.default_rng(41)
    x = rng.normal(size=(6000, 256)).astype(np.float32)
    df = frame(spark, x, np.zeros(len(x), int)).repartition(4)
    got = {}
    for r in ann.nearest_neighbours(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = ann.unit(x.astype(float))
    hits = []
    for q in range(0, len(x), 50):
        s = u @ u[q]
        s[q] = -2
        hits.append(len(set(np.argsort(-s)[:5].tolist()) & got[q]) / 5)
    assert np.mean(hits) >= 0.95
