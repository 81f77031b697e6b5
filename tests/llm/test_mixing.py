"""Mixing against iterative resharing and the laws of systematic sampling."""

import random

from pyspark.sql import functions as F

from millrace.llm import mixing


def resharing(sizes, weights=(1, 2, 3), most=3):
    """Targets by repeated resharing of the excess."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        room = total - sum(capped.values())
        target = {s: room * w[s] / sum(w[x] for x in left) for s in left} if left else {}
        over = [s for s in left if target[s] > most * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


def test_targets_equal_iterative_resharing(spark):
    rng = random.Random(4)
    for n in (1, 2, 7, 20):
        sizes = {f"s{i}": rng.choice([0, 5, 40, 300, 9000]) for i in range(n)} | ({None: 17} if n % 2 else {})
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = resharing(sizes)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * (1 + want[k]) for k in want)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_copies_and_mix(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", None] + ["hot"] * 8), "clash") for i in range(900)]
    rows += [(None, None, "a", None), (7, "same row", "b", None), (7, "same row", "b", None)]
    docs = docs_of(spark, rows)
    got = mixing.systematic_copies(docs).collect()
    assert len(got) == len(rows)
    taken, target = {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 120 for s in target)
    again = mixing.systematic_copies(docs.orderBy(F.rand(3)).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)


def test_empty(spark):
    assert mixing.systematic_copies(docs_of(spark, [])).count() == 0
    assert mixing.mix(docs_of(spark, [(1, "", "a", None)])).count() == 0
