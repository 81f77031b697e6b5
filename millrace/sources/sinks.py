"""Sinks: headed CSV, brand partitions, idempotent upserts, JSON catalogue, result lines."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import blank

#: Columns that make two records the same location.
LOCATION_KEY = ("brand", "franchisee_name", "raw_address", "city", "zip")
#: Buckets of an upserted table by default; about the table's bytes / 256 MB is a good number.
BUCKETS = 64


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite with headed CSV; an empty input writes an empty table, so nothing stale stays."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def append_brand(df: DataFrame, path: str) -> None:
    """Append records as Parquet, a folder for each brand."""
    df.write.mode("append").partitionBy("brand").parquet(path)


def _norm(key: tuple[str, ...]) -> list[Column]:
    return [F.lower(F.trim(blank(F.col(k)))) for k in key]


def dedupe_first(old: DataFrame, new: DataFrame, key: tuple[str, ...] = LOCATION_KEY, order: str = "ord") -> DataFrame:
    """old and new together, the first of each lower-case, trimmed key; old rows come first."""
    both = old.withColumn("new_", F.lit(0)).unionByName(new.withColumn("new_", F.lit(1)))
    names = [f"k{i}_" for i in range(len(key))]
    keyed = both.select("*", *(k.alias(n) for k, n in zip(_norm(key), names)))
    return keyed.groupBy(*names).agg(F.min_by(F.struct(*both.columns), F.struct("new_", order)).alias("r")).select("r.*").drop("new_")


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions under path, oldest first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/manifests")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(str(x.getPath().getName()) for x in fs.listStatus(root)) if fs.exists(root) else []
    return [v for v in names if fs.exists(hadoop.Path(f"{path}/manifests/{v}/_SUCCESS"))]


def _manifest(spark: SparkSession, path: str, version: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifests/{version}").first()[0])


def _read_buckets(spark: SparkSession, path: str, manifest: dict, only: set[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/data/{v}/bucket_={b}" for b, v in sorted(manifest["buckets"].items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """A version of an upserted table, the newest by default; ValueError if there is none."""
    version = version or next(reversed(_manifests(spark, path)), None)
    if version is None:
        raise ValueError(f"no version under {path}")
    return _read_buckets(spark, path, _manifest(spark, path, version))


def upsert(spark: SparkSession, df: DataFrame, path: str, version: str, key: tuple[str, ...] = LOCATION_KEY, buckets: int = BUCKETS) -> int:
    """Merge df into the newest version under path and write the next one; returns the net number of new rows, which may be negative.

    A table is dealt into buckets by the hash of the key. Only buckets that df has keys of are
    read, merged and written; a version's manifest, written last, names the version that holds
    each bucket, so older versions stay readable. The first version sets the number of buckets
    and the columns. Rerunning the newest version replaces it; ValueError for an older one,
    since newer ones read its files.
    """
    done = _manifests(spark, path)
    if any(v > version for v in done):
        raise ValueError(f"{version} is older than {done[-1]}")
    before = [v for v in done if v < version]
    base = _manifest(spark, path, before[-1]) if before else {"n": buckets, "schema": df.schema.jsonValue(), "buckets": {}}
    bucket = F.pmod(F.xxhash64(*_norm(key)), F.lit(base["n"])).cast("int")
    touched = {str(r[0]) for r in df.select(bucket).distinct().collect()}  # at most the number of buckets
    old = _read_buckets(spark, path, base, touched)
    merged = dedupe_first(old, df, key).withColumn("bucket_", bucket)
    merged.repartition("bucket_").write.mode("overwrite").partitionBy("bucket_").parquet(f"{path}/data/{version}")
    manifest = base | {"buckets": base["buckets"] | dict.fromkeys(touched, version)}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifests/{version}")
    return _read_buckets(spark, path, manifest, touched).count() - old.count()


def merge_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left rows with the columns of right; where both have a column, right wins."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    return left.drop(*shared).join(right, key, "left")


def catalogue_json(brands: DataFrame, updated: str) -> DataFrame:
    """One JSON document: date, count and brands in order of name. A report for people: the catalogue is small by nature."""
    body = F.array_sort(F.collect_list(F.struct("name", "tags", "source")))
    return brands.agg(body.alias("brands")).select(F.to_json(F.struct(F.lit(updated).alias("updated"), F.size("brands").alias("count"), "brands")).alias("value"))


def result_line(kind: str, *parts: Column) -> Column:
    """A machine-readable line: fields joined by pipes."""
    return F.concat_ws("|", F.lit(kind), *parts)


def read_result_line(line: Column) -> Column:
    """Fields of a result line."""
    return F.split(line, r"\|")


def progress(lines: DataFrame) -> DataFrame:
    """doc_id, content_hash: md5 of a document's joined lines, the key of its partial results."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda s: s["text"]), "\n")
    return lines.groupBy("doc_id").agg(F.md5(text.cast("binary")).alias("content_hash"))


def resume_from(current: DataFrame, saved: DataFrame) -> DataFrame:
    """doc_id, next_batch_start: where to go on; 0 if the content changed or was never seen."""
    s = saved.select("doc_id", F.col("content_hash").alias("h_"), "next_batch_start")
    return current.join(s, "doc_id", "left").select("doc_id", F.when(F.col("content_hash") == F.col("h_"), F.col("next_batch_start")).otherwise(0).cast("long").alias("next_batch_start"))
