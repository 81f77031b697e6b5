"""Shared pieces of the training-data operators."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; words are maximal runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of an Arrow batch: long texts make a batch of the default 10,000 rows too large.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts can hold. The settings are the session's and stay; smaller ones are left alone."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))


def text_bytes(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each value of an Arrow string column, without decoding."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return []
    valid, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].tolist()
    raw = memoryview(data) if data is not None else memoryview(b"")
    out: list[bytes | None] = [raw[a:b].tobytes() for a, b in zip(at, at[1:])]
    if valid is not None and col.null_count:
        for i in np.flatnonzero(~np.asarray(col.is_valid())):
            out[i] = None
    return out


def per_process(name: str, make):
    """A value made once in a Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def doc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def row_hash(docs: DataFrame, leave: tuple[str, ...] = ()) -> Column:
    """Hash of a row's columns other than ``leave``; columns with maps, which Spark cannot hash, count as their text."""
    cols = [F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name] for f in docs.schema if f.name not in leave]
    return F.xxhash64(*cols, F.lit(0))


def whole(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that working columns beside it clash with none."""
    return F.struct(*(docs[c] for c in docs.columns))
