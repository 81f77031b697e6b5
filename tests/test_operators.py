"""Operators on small fixtures, and every query of the registry on the smallest data."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import registry
from millrace.operators import lookup, ordered, resolution, rollup
from millrace.operators.components import connected_components
from millrace.plans import directory
from millrace.sources import readers, sinks
from millrace.streaming import incremental

RAW = [
    (1, "Alpha Grill", "Example Foods, Llc", "1 Test St", "Springfield", "TX", "75001", "(555) 010-0001"),
    (2, "Alpha Grill", "EXAMPLE FOODS, LLC", "2 Test St", "Shelbyville", "TX", "75002-1234", ""),
    (3, "Alpha Grill", "Sample Holdings Llc (Pat Doe)", "3 Test St", "Ogden", "UT", "84401", ""),
    (4, "Alpha Grill", "Other Holdings Llc (Pat Doe)", "4 Test St", "Provo", "UT", "84601", ""),
    (5, "Beta Pizza", "Example Foods Llc", "5 Test Ave", "Springfield", "TX", "75001", "5550100005"),
    (6, "Beta Pizza", "3849-0001", "6 Test Ave", "Austin", "TX", "73301", ""),
]
COLUMNS = "ord long, brand string, franchisee_name string, raw_address string, city string, state string, zip string, restaurant_phone string"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, COLUMNS)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 3), (5, 5)]
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: find(n) for n in list(root)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_in_one_task_and_in_rounds(spark):
    rng = random.Random(3)
    edges = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(250)] + [(i + 1, i) for i in range(1000, 1060)] + [(7, 7), (1, None)]
    for kind, value in (("bigint", int), ("int", int), ("string", str)):
        df = spark.createDataFrame([(value(a), b if b is None else value(b)) for a, b in edges], f"src {kind}, dst {kind}").repartition(5)
        got = [connected_components(df, one_task=most) for most in (1 << 18, 0)]
        assert got[0].dtypes == got[1].dtypes == [("node", kind), ("component", kind)]
        rows = [sorted(map(tuple, x.collect())) for x in got]
        assert rows[0] == rows[1] and len({r[0] for r in rows[0]}) == len(rows[0])


def test_components_of_few_edges_are_few_tasks(spark):
    # A chain of shuffled numbers takes several rounds; each was eight shuffles over all partitions.
    nodes = random.Random(6).sample(range(5000), 500)
    df = spark.createDataFrame(list(zip(nodes, nodes[1:])), "src long, dst long")
    conf, sc = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, spark.sparkContext
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few edges", "few edges")
        got = connected_components(df).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(j).stageIds}
    assert len(got) == 500 and {r["component"] for r in got} == {min(nodes)}
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) < 300


def test_resolution_and_rollup(raw):
    exact = {r["ord"]: r["comp"] for r in resolution.resolve(raw, auto=False).collect()}
    assert exact == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
    full = {r["ord"]: r["comp"] for r in resolution.resolve(raw).collect()}
    assert full == {1: 1, 2: 1, 3: 3, 4: 3, 5: 1, 6: 6}  # equal words across brands merge by themselves
    top = rollup.operators(resolution.resolve(raw)).orderBy(F.col("total_units").desc(), "first_ord").first()
    assert (top["franchisee_name"], top["total_units"], top["brands_operated"], top["is_multi_brand"], top["primary_state"], top["restaurant_phone"]) == ("Example Foods, Llc", 3, "Alpha Grill | Beta Pizza", "Yes", "TX", "(555) 010-0001")


def test_decisions(spark, raw):
    pairs = resolution.candidate_pairs(resolution.representatives(raw), same=40, cross=40)
    keyed = resolution.pair_keys(pairs).filter("score < 96")
    some = keyed.orderBy("a_ord", "b_ord").first()
    decisions = spark.createDataFrame([(some["pair_key"], True, 65)], "pair_key string, match boolean, confidence int")
    routed = {r["pair_key"]: (r["route"], r["accepted"]) for r in resolution.cascade(pairs, decisions).collect()}
    assert routed[some["pair_key"]] == ("cached", False)  # confidence under 70
    left = resolution.pending_pairs(resolution.cascade(pairs, decisions))
    assert resolution.pending_pairs(resolution.cascade(pairs, decisions), left.select("pair_key")).count() == 0


def test_tiers(spark):
    df = spark.createDataFrame([("4",), ("5",), ("15",), ("16",), ("200",), ("201",), ("x",)], "u string")
    assert [r[0] for r in df.select(rollup.tier_of(F.col("u"))).collect()] == ["small", "B", "B", "A", "A", "large", None]


def test_classified_answers(spark, raw):
    answers = spark.createDataFrame([("3849-0001", "person", "Known Person")], "franchisee_name string, entity_type string, search_target string")
    got = {r["franchisee_name"]: (r["entity_type"], r["classification_method"], r["search_target"]) for r in directory.classified(raw, answers).collect()}
    assert got["3849-0001"] == ("person", "cache", "Known Person")
    assert got["Other Holdings Llc (Pat Doe)"] == ("company_with_owner", "regex", "Pat Doe")


def test_densest_run(spark):
    pages = spark.createDataFrame([("d", i + 1, s) for i, s in enumerate([0, 1, 9, 8, 0, 0, 7, 0, 0, 0, 30, 0])] + [("e", 1, 4)], "doc_id string, page_no int, score long")
    runs = sorted(tuple(r) for r in ordered.page_runs(pages).collect())
    assert runs == [("d", 3, 7, 24), ("d", 11, 11, 30)]
    assert [tuple(r) for r in ordered.densest_run(pages).collect()] == [("d", 10, 12, 30)]


def test_take_while(spark):
    lines = ordered.lines_of(spark.createDataFrame([("d", "a\nb\nDID NOT RENEW\nc"), ("e", "x\ny")], "doc_id string, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in ordered.take_while(lines).collect()) == [("d", "a"), ("d", "b"), ("e", "x"), ("e", "y")]


def test_first_variant(spark):
    inputs = spark.createDataFrame([(1, "Acme Foods, LLC (Pat)"), (2, "Zed Inc")], "ord long, entity_name string")
    found = spark.createDataFrame([("Acme Foods",)], "query string")
    got = {r["entity_name"]: (r["query"], r["attempts"]) for r in lookup.first_variant(inputs, found).collect()}
    assert got == {"Acme Foods, LLC (Pat)": ("Acme Foods", "Acme Foods, LLC (Pat) | Acme Foods, LLC | Acme Foods"), "Zed Inc": ("", "Zed Inc")}


def test_sources_and_sinks(spark, raw, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "b_raw.csv").write_text("﻿brand,franchisee_name\nB,two\nB,three\n", encoding="utf-8")
    (tmp_path / "a_raw.csv").write_text("brand,franchisee_name\nA,one\n", encoding="utf-8")
    got = readers.read_registry_csv(spark, f"{folder}/b_raw.csv", "brand")
    assert got.columns == ["brand", "franchisee_name"] and got.count() == 2
    with pytest.raises(ValueError, match="no column entity_name"):
        readers.read_registry_csv(spark, f"{folder}/a_raw.csv", "entity_name")
    rows = readers.read_raw_records(spark, f"{folder}/a_raw.csv").collect()
    assert [(r["franchisee_name"], r["ord"]) for r in rows] == [("one", 0)]
    assert readers.read_if_there(spark, f"{folder}/none.csv", "a string").count() == 0
    assert sinks.upsert(spark, raw, f"{folder}/t", "v1") == 6
    more = raw.filter("ord = 1").unionByName(raw.filter("ord = 2").withColumn("raw_address", F.lit("new")))
    assert sinks.upsert(spark, more, f"{folder}/t", "v2") == 1
    assert sinks.upsert(spark, more, f"{folder}/t", "v2") == 1  # again from the version before
    assert sinks.read_version(spark, f"{folder}/t", "v1").count() == 6 and sinks.read_version(spark, f"{folder}/t").count() == 7
    # Two keys touch two buckets at most; the others stay in the version before.
    assert len(list((tmp_path / "t/data/v2").glob("bucket_=*"))) <= 2 < len(list((tmp_path / "t/data/v1").glob("bucket_=*")))
    with pytest.raises(ValueError, match="older"):
        sinks.upsert(spark, more, f"{folder}/t", "v1")
    assert sinks.upsert(spark, raw.limit(0), f"{folder}/empty", "v1") == 0 and sinks.read_version(spark, f"{folder}/empty").columns == raw.columns
    with pytest.raises(ValueError, match="no version"):
        sinks.read_version(spark, f"{folder}/none")


def test_pdf_pages(spark, tmp_path):
    (tmp_path / "good.pdf").write_bytes(b"%PDF one|two")
    (tmp_path / "bad.pdf").write_bytes(b"<html>")
    pages = readers.pdf_pages(spark, str(tmp_path), lambda content: content.decode()[5:].split("|"))
    assert sorted(tuple(r) for r in pages.collect()) == [("good.pdf", 1, "one"), ("good.pdf", 2, "two")]


def test_stream(spark, tmp_path):
    inbox, table, marks = (str(tmp_path / x) for x in ("in", "table", "marks"))
    schema = "ord long, brand string, franchisee_name string, raw_address string, city string, zip string"
    rows = [(1, "A", "x", "1 st", "c", "1"), (2, "A", "X", "1 ST", "C", "1"), (3, "A", "y", "2 st", "c", "1")]

    def arrive(part):
        spark.createDataFrame(part, schema).write.mode("append").option("header", True).csv(inbox)
        incremental.ingest(incremental.new_records(spark, inbox, schema), table, marks).awaitTermination()

    arrive(rows)
    arrive([(4, "A", "Y", "2 st", "c", "1"), (5, "A", "z", "3 st", "c", "1")])
    assert sorted(r["ord"] for r in sinks.read_version(spark, table).collect()) == [1, 3, 5]
    assert incremental.distinct_locations(spark.createDataFrame(rows, schema)).count() == 2


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_run(spark, name):
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
