"""The queries of this subpackage by name, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, attribution, langid, mixing, packing, quality, secrets, sharding, simhash, vectors
from .common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each whole text."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of each vector."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: base spans and linked ones."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes."""
    return mixing.systematic_copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document."""
    return attribution.token_counts(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document."""
    return sharding.feistel_shards(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each document's pieces in sequences."""
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(rows, rows.filter("vec_id % 50 = 0"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each whole text."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_langid, op2_simhash, op3_embedding_dedup, op4_secrets, op5_mixing, op6_token_counts, op7_sharding, op8_packing, op9_ann, op10_quality)}
ORACLES = {"op4_secrets": secrets.ORACLE, "op5_mixing": mixing.ORACLE}
