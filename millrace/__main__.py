"""Command line: python -m millrace match|filter|classify|enrich ... (paths are anything Spark reads or writes)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.rollup import histogram, icp_rows
from .plans import directory, enrich
from .sources import readers, sinks


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("ord", F.monotonically_increasing_id())


def _match(spark: SparkSession, a) -> None:
    decisions = spark.read.parquet(a.decisions) if a.decisions else None
    ops = directory.registry(readers.read_raw_records(spark, f"{a.input}/*_raw.csv"), decisions)
    sinks.write_csv(ops.orderBy(F.col("total_units").desc(), "first_ord").drop("comp", "first_ord"), a.output)


def _filter(spark: SparkSession, a) -> None:
    ops = readers.read_registry_csv(spark, a.input, "franchisee_name")
    sinks.write_csv(icp_rows(ops).orderBy(F.col("total_units").cast("int").desc(), "franchisee_name"), a.output)
    histogram(ops.withColumn("total_units", F.col("total_units").try_cast("int"))).show()


def _classify(spark: SparkSession, a) -> None:
    rows = readers.read_registry_csv(spark, a.input, "franchisee_name")
    answers = spark.read.parquet(a.answers) if a.answers else None
    sinks.write_csv(directory.classified(rows, answers), a.output)


def _enrich(spark: SparkSession, a) -> None:
    from .operators.lookup import not_done

    inputs = _numbered(readers.read_registry_csv(spark, a.input, "entity_name"))
    if a.rescore_only:
        sinks.write_csv(enrich.rescore(inputs, a.state).drop("ord"), a.output)
        return
    if a.done:
        inputs = not_done(inputs, readers.read_registry_csv(spark, a.done), a.limit)
    elif a.limit:
        inputs = inputs.orderBy("ord").limit(a.limit)
    registry = readers.read_cordata(spark, a.registry) if a.state == "fl" else readers.read_registry_csv(spark, a.registry)
    sinks.write_csv(enrich.enrich(inputs, registry, a.state).drop("ord"), a.output)


def main(argv: list[str] | None = None) -> None:
    """Parse and run."""
    p = argparse.ArgumentParser(prog="millrace", description=__doc__)
    sub = p.add_subparsers(required=True)
    for name, run in (("match", _match), ("filter", _filter), ("classify", _classify), ("enrich", _enrich)):
        s = sub.add_parser(name)
        s.set_defaults(run=run)
        s.add_argument("input")
        s.add_argument("output")
        if name == "match":
            s.add_argument("--decisions")
        if name == "classify":
            s.add_argument("--answers")
        if name == "enrich":
            s.add_argument("--state", required=True, choices=sorted(enrich.BUILD))
            s.add_argument("--registry")
            s.add_argument("--done")
            s.add_argument("--limit", type=int, default=0)
            s.add_argument("--rescore-only", action="store_true")
    a = p.parse_args(argv)
    a.run(SparkSession.builder.appName("millrace").getOrCreate(), a)


if __name__ == "__main__":
    main()
