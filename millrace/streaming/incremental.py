"""Incremental ingestion: new files since the last run, duplicates dropped, merged into a versioned table.

The checkpoint holds which files were read; a rerun of a batch writes the same version
again, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import blank
from ..sources.sinks import upsert


def new_records(spark: SparkSession, folder: str, schema: str, kind: str = "csv") -> DataFrame:
    """A stream of the files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100)
    return (reader.option("header", True) if kind == "csv" else reader).format(kind).load(folder)


def distinct_locations(stream: DataFrame, key: tuple[str, ...] = ("franchisee_name", "raw_address")) -> DataFrame:
    """The first of each lower-case key; with an event time, state is bounded by its watermark."""
    names = [f"k{i}_" for i in range(len(key))]
    keyed = stream.select("*", *(F.lower(F.trim(blank(F.col(k)))).alias(n) for k, n in zip(key, names)))
    return keyed.dropDuplicates(names).drop(*names)


def ingest(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Merge everything that has arrived into the table, then stop."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, batch, table, f"v{number:08d}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
