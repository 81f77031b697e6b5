"""Sharding by a Feistel permutation of global row numbers (operator 7).

Rows get gapless numbers 0..N-1 in the order of a content hash (two-level prefix
counts over hash buckets, so no task numbers all rows). A balanced Feistel network on
the smallest even-bit domain holding N, walked until it lands below N, permutes them;
shard = position mod shards, slot = position div shards. Counts per shard differ by at
most one (law ``rows``), and place()/row_at() compute either way without any table.

Defined results: null text has size 1 and checksum 0; null ids and repeated rows are
numbered like any row (equal rows are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

SHARDS = 16
SEED = 20
ROUNDS = 6
#: Hash buckets for numbering rows; their counts are a table of this many rows whatever the input.
BUCKETS = 4096


def half_bits(n: int) -> int:
    """Bits in each half of the smallest domain 4**half that holds n rows."""
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(rows: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Positions of row numbers (or with ``inverse``, row numbers of positions), both in 0..n-1."""
    half = np.uint64(half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [(seed * 1_000_003 + 7919 * r) % (1 << 61) for r in range(ROUNDS)]
    out = np.asarray(rows, np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> half, x & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left, key) & mask), left
            else:
                left, right = right, left ^ (_mix(right, key) & mask)
        x = (left << half) | right
        out[walking] = x
        walking = walking[x >= np.uint64(n)]
    return out.astype(np.int64)


def place(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number."""
    at = int(permute(np.array([row]), n, seed)[0])
    return at % shards, at // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that lies at a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(rows: DataFrame, key: str, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Add ``row_number_`` 0..N-1 by bucket of the hash in ``key``, then ``order``; deterministic."""
    rows = rows.withColumn("bucket_", F.pmod(F.col(key), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("bucket_").agg(F.count("*").alias("n_"))
    before = counts.select("bucket_", F.coalesce(F.sum("n_").over(Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    ranked = rows.withColumn("rank_", F.row_number().over(Window.partitionBy("bucket_").orderBy(key, *order)))
    return ranked.join(before, "bucket_").withColumn("row_number_", F.col("before_") + F.col("rank_") - 1).drop("bucket_", "rank_", "before_")


def feistel_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number for every row."""
    slim = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    slim = cut(slim.withColumn("h", F.xxhash64("doc_id", "text_crc32", "size")))
    n = slim.count()

    @F.pandas_udf(T.LongType())
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    placed = number_rows(slim, "h", ["doc_id", "text_crc32", "size"]).withColumn("at", position("row_number_"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("at") % shards).cast("int").alias("shard"), F.floor(F.col("at") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("row_number_").alias("row_number"))
