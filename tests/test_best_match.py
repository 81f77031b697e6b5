"""Best matches: two passes of the registry, short structs by name, and everything derived once a name."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import lookup
from millrace.plans import enrich

FIELDS = ("entityid", "entityname", "entitystatus", "entitytype", "entityformdate", "jurisdictonofformation", "agentfirstname", "agentmiddlename", "agentlastname", "agentsuffix", "agentorganizationname", *(p + n for p in ("principal", "mailing", "agentprincipal") for n in ("address1", "address2", "city", "state", "zipcode")))


def registry(spark, n):
    """n Colorado records of three names, five states of standing."""
    known = {
        "entityid": F.col("id").cast("string"), "entityname": F.concat(F.lit("ACME FOODS "), (F.col("id") % 3).cast("string"), F.lit(" LLC")),
        "entitystatus": F.element_at(F.array(*map(F.lit, ("Good Standing", "Delinquent", "Exists", "Merged", "Noncompliant"))), (F.col("id") % 5 + 1).cast("int")),
        "entitytype": F.lit("DLLC"), "entityformdate": F.concat(F.lit("20"), F.lpad((F.col("id") % 20).cast("string"), 2, "0"), F.lit("-01-02")),
        "principaladdress1": F.concat((F.col("id") % 4).cast("string"), F.lit(" Main Street"), F.repeat(F.lit(" x"), 200)),
    }
    return spark.range(0, n, 1, 4).select(*(known.get(f, F.lit("")).alias(f) for f in FIELDS))


def inputs(spark):
    return spark.createDataFrame([(1, "Acme Foods 0, Llc"), (2, "Acme Foods 1 Inc."), (3, "Acme Foods 0, Llc"), (4, "Nobody At All"), (5, None)], "ord long, entity_name string")


def written(spark, run):
    """Bytes that checkpoints add while run() goes."""
    top = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    size = lambda: {p: os.path.getsize(p) for d, _, names in os.walk(top) for p in (os.path.join(d, x) for x in names)}
    before = size()
    run()
    return sum(b for p, b in size().items() if p not in before)


def test_matches_are_not_kept(spark):
    enrich.best_matches(inputs(spark), registry(spark, 30), "co").collect()
    few, many = (written(spark, lambda n=n: enrich.best_matches(inputs(spark), registry(spark, n), "co").collect()) for n in (300, 6000))
    assert many < 2 * few


def test_best_and_alternates_by_rank(spark):
    rows = registry(spark, 600)
    got = {r["entity_name"]: r for r in enrich.best_matches(inputs(spark), rows, "co").collect()}
    assert sorted(got) == ["Acme Foods 0, Llc", "Acme Foods 1 Inc."]
    for k, name in enumerate(sorted(got)):
        points = {"Good Standing": 100.0, "Noncompliant": 80.0, "Delinquent": 0.0, "Exists": 50.0, "Merged": -50.0}
        every = rows.filter(F.col("entityname") == f"ACME FOODS {k} LLC")
        ranked = sorted((-points[r["entitystatus"]], -int(r["entityformdate"][:4]), r["entityid"]) for r in every.collect())
        best = got[name]
        assert best["entityid"] == ranked[0][2] and best["match_count"] == 200 and best["entityname"] == f"ACME FOODS {k} LLC"
        assert [a["num"] for a in best["alternates"]] == [r[2] for r in ranked[1:6]]


@pytest.mark.parametrize("number", ["", None])
def test_records_without_number(spark, number):
    rows = registry(spark, 60).withColumn("entityid", F.lit(number).cast("string"))
    got = enrich.best_matches(inputs(spark), rows, "co").collect()
    assert [(r["match_count"], r["entitystatus"], len(r["alternates"])) for r in got] == [(20, "Good Standing", 5)] * 2
    assert all(r["entityid"] == number for r in got)


def test_fewer_records_than_alternates(spark):
    got = {r["entity_name"]: r for r in enrich.best_matches(inputs(spark), registry(spark, 5), "co").collect()}
    assert [(got[n]["match_count"], got[n]["alternates"] and len(got[n]["alternates"])) for n in sorted(got)] == [(2, 1), (2, 1)]
    alone = enrich.best_matches(inputs(spark), registry(spark, 1), "co").collect()
    assert [(r["match_count"], r["alternates"]) for r in alone] == [(1, None)]
    assert enrich.best_matches(inputs(spark), registry(spark, 0), "co").collect() == []


def test_sieve_loses_no_value(spark):
    every = spark.range(20_000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"))
    some = every.filter("k is null or hash(k) % 40 = 0")
    kept = every.filter(lookup.sieve(every["k"], some))
    assert some.exceptAll(kept).count() == 0 and kept.count() < some.count() + 300
    assert every.filter(lookup.sieve(every["k"], some.limit(0))).count() == 0


def test_hot_name_takes_no_sort(spark):
    rows = spark.range(100).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("s"), F.col("id").cast("string").alias("n"))
    plan = lookup.best_and_alternates(rows, "k", "s", "n", {"num": F.col("n")})._jdf.queryExecution().sparkPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_names_share_what_is_derived(spark):
    """Rows of the same name are told apart by ord only; unmatched and missing names stay; signals count inputs."""
    rows = registry(spark, 60).withColumn("principaladdress1", F.concat("entityid", F.lit(" Main Street")))
    got = {r["ord"]: r.asDict() for r in enrich.enrich(inputs(spark), rows, "co", fetched_at="now").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert {**got[1], "ord": 3} == got[3] and got[1]["co_match_count"] == "20"
    assert (got[4]["co_match_count"], got[4]["co_query_used"], got[4]["co_entity_number"], got[4]["co_multi_entity_operator"]) == ("0", "Nobody At All", None, "")
    assert (got[5]["co_match_count"], got[5]["co_query_used"], got[5]["entity_name"]) == ("0", None, None)
    assert [got[k]["co_multi_entity_operator"] for k in (1, 2, 3)] == ["True", "False", "True"]
    assert {r["co_fetched_at"] for r in got.values()} == {"now"}


def test_lines_are_not_kept(spark, tmp_path):
    """The Florida enrichment keeps names, not the registry's lines: four times the records add little."""
    from millrace.plans.queries import QUERIES

    sizes = []
    for n in (500, 2000):
        spark.range(0, n, 1, 2).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/{n}/orders.parquet")
        spark.range(0, 400, 1, 2).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/{n}/customer.parquet")
        sizes.append(written(spark, lambda n=n: QUERIES["j_enriched_florida"](spark, f"{tmp_path}/{n}").collect()))
    assert sizes[1] < 2 * sizes[0]
