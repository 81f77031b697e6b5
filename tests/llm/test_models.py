"""Language network and quality classifier: gradients, held-out accuracy, parts against plain versions."""

import random
import zlib

import numpy as np

from millrace.llm import langid, quality


def test_gradient_through_time():
    net = langid.Network(["a", "b", "c"], hidden=3, seed=3)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (7, 5)), rng.integers(0, 3, 5)
    mask = (rng.random((7, 5)) < 0.8).astype("f4")
    _, g = net.gradient(x, y, mask)
    for k in net.p:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old, step = net.p[k][at], 2e-2
        net.p[k][at] = old + step
        up = net.gradient(x, y, mask)[0]
        net.p[k][at] = old - step
        down = net.gradient(x, y, mask)[0]
        net.p[k][at] = old
        assert abs((up - down) / 2 / step - g[k][at]) < 0.05 * abs(g[k][at]) + 1e-3


def test_pooling_covers_every_position():
    net = langid.Network(["a", "b"], seed=2)
    texts = [b"x", b"hello " * 100, b"y" * langid.WINDOW, b"z" * (langid.WINDOW + 1)]
    prob, label = langid.pooled(net, texts)
    assert np.allclose(prob.sum(axis=1), [len(t) for t in texts])
    for t, row in zip(texts, label):
        assert np.array_equal(np.bincount(langid.position_labels(net, t), minlength=2), row)


def corpus(n=260):
    rng = random.Random(6)
    words = {"en": "the of and that with for was this".split(), "fr": "les des une dans pour pas est que".split(), "de": "der die und das nicht mit eine ist".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(words))
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(rng.randint(5, 80)))
        junk = rng.random() < 0.3
        rows.append((i, " ".join(w + "###" for w in text.split()) if junk else text + ".", lang, int(not junk)))
    return rows


def test_held_out_language(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows], "doc_id long, text string, lang string")
    lang = {i: k for i, _, k, _ in rows}
    got = langid.identify(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_held_out_quality(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in rows if i % 5], "doc_id long, quality int, toxic int")
    good = {i: q for i, _, _, q in rows}
    got = quality.classify(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert np.mean([r["predicted"] == good[r["doc_id"]] for r in got if r["held_out"]]) > 0.95
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept == {r["doc_id"] for r in got if r["predicted"]}


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows = corpus(120)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    flip = lambda i, q: 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q
    a, b = ([(i, f(i, q), 0) for i, _, _, q in rows] for f in (lambda i, q: q, flip))
    out = [sorted((r["doc_id"], round(r["score"], 9)) for r in quality.classify(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (a, b)]
    assert out[0] == out[1]


def test_isotonic():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0, 5, 1, 9.0]), np.array([10, 10, 10, 10.0]))
    assert list(x) == [0, 1.5, 3] and list(np.diff(y) > 0) == [True, True]
    assert quality.isotonic(np.zeros(2), np.zeros(2), np.zeros(2))[0].tolist() == []


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, quality.N_STATS))
    model = quality.Model(x, features=6000)
    z = model.features(x)[:, :-1]
    u = model._scaled(x) @ np.eye(quality.N_STATS)
    width2 = 1 / model.w.var()
    exact = np.exp(-((u[:, None] - u[None]) ** 2).sum(axis=2) / 2 / width2)
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_sums_of_many_partitions_meet_in_levels(spark, monkeypatch):
    monkeypatch.setattr(quality, "MEET", 3)
    rows = spark.range(200).selectExpr(f"transform(sequence(1, {quality.N_STATS}), x -> cast(id + x as float)) AS stats", "cast(id % 2 as double) AS y", "id % 4 AS fold").repartition(29)
    got = quality._sums(rows, lambda x, y, fold: np.array([len(x), y.sum(), x[:, 0].sum(), fold.sum()], float), 4)
    assert got.tolist() == [200, 100, sum(range(1, 201)), 300]


def test_scores_equal_one_plain_process(spark):
    """The distributed sums give the ridge weights and the isotonic curve of a plain computation over all rows."""
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in rows], "doc_id long, quality int, toxic int")
    model = quality.fit(quality.stats_of(docs), labels)
    fold = {r["doc_id"]: r["f"] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {quality.FOLDS}) AS f").collect()}
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    x = np.array([quality.statistics(t.encode()) for _, t, _, _ in train], np.float32)
    y, f = np.array([q for _, _, _, q in train], float), np.array([fold[i] for i, _, _, _ in train])
    assert np.allclose(model.mean, x.astype(float).mean(axis=0), rtol=1e-5)
    z, d = model.features(x), quality.FEATURES + 1
    raw = np.zeros(len(y))
    for k in [*range(quality.FOLDS), None]:
        own = np.ones(len(y), bool) if k is None else f != k
        penalty = quality.RIDGE * own.sum() / quality.FEATURES * np.diag([*[1.0] * (d - 1), 0.0]) + 1e-9 * np.eye(d)
        w = np.linalg.solve(z[own].T @ z[own] + penalty, z[own].T @ y[own])
        assert np.allclose(z @ w, z @ model.weights[quality.FOLDS if k is None else k], atol=1e-5)
        if k is not None:
            raw[f == k] = z[f == k] @ w
    at = np.clip(((raw + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS - 1)
    means, ones, count = (np.array([v[at == b].sum() for b in range(quality.BINS)]) for v in (raw, y, np.ones(len(y))))
    cuts, values = quality.isotonic(means / np.maximum(count, 1), ones, count)
    assert np.allclose(cuts, model.cuts, atol=1e-4) and np.allclose(values, model.values, atol=1e-4)


def test_network_equals_a_plain_loop():
    """States and probabilities at every byte, one byte and one unit at a time."""
    net = langid.Network(["a", "b", "c"], hidden=4, seed=9)
    text = "Größe, élan 12".encode()
    soft = lambda v: v / (1 + abs(v))

    def states(d, order):
        h, out = np.zeros(4), {}
        for t in order:
            p, b = net.p, text[t]
            z = 0.5 * (1 + soft(p[f"Wz{d}"][b] + h @ p[f"Uz{d}"]))
            r = 0.5 * (1 + soft(p[f"Wr{d}"][b] + h @ p[f"Ur{d}"]))
            n = soft(p[f"Wn{d}"][b] + r * (h @ p[f"Un{d}"]))
            h = n + z * (h - n)
            out[t] = h
        return out

    fore, back = states("f", range(len(text))), states("b", range(len(text) - 1, -1, -1))
    logits = np.array([fore[t] @ net.p["Vf"] + back[t] @ net.p["Vb"] + net.p["c"] for t in range(len(text))])
    want = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    got = net.probabilities(np.frombuffer(text, np.uint8).astype(np.intp)[:, None])[:, :, 0].T
    assert np.allclose(got, want, atol=1e-5)


def test_every_language_is_learned(spark):
    """More languages than any former bound: each is in the sample and in the network."""
    rows = [(i, f"text {i} in tongue {i % 1100} of letters", f"l{i % 1100:04d}") for i in range(3300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    net = langid.fit(docs, steps=2)
    assert set(net.langs) == train and len(train) > 1024
    assert langid.pooled(net, [b"abc " * 700, b"x"])[0].shape == (2, len(train))
