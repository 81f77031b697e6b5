"""Session helpers: a tuned builder and reliable lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
import time
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build(app: str = "millrace", cores: int | str = 8, shuffle: int = 8, driver_memory: str = "12g") -> SparkSession:
    """A local session with the settings the engine expects (AQE, UTC, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir``, or, on a local master only, a temporary one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "millrace-checkpoints"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder; it survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def once(value: Column) -> Column:
    """The value, built once a row: behind a condition that always holds but counts as nondeterministic, so Spark neither copies the expression to each use nor moves filters on it below a shuffle."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def measured(df: DataFrame) -> DataFrame:
    """A table that is joined to a larger one: cut, and marked for broadcast if its measured size is within the session's threshold.

    Estimates start from the files and miss a grouped table's size; a wrong one would shuffle the whole larger side.
    """
    df = cut(df)
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t == "string"]
    size = df.agg(F.sum(reduce(lambda a, b: a + b, text, F.lit(16 + 16 * len(df.columns))).cast("long"))).first()[0] or 0
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(df) if size <= limit else df


@contextmanager
def many_groups(spark: SparkSession, groups: int = 1 << 14):
    """While it lasts, a task that keeps objects by key holds so many keys before Spark has it sort its rows (128 by default)."""
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(groups))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession, pause: float = 0.3) -> None:
    """Have Spark drop the shuffle files that a cut left without a reader.

    Its cleaner learns of them when the driver collects garbage, which can be long after large
    shuffles with few tasks. The latest shuffle goes only at a second collection, once the cleaner is done with the first.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def spread(df: DataFrame, task_bytes: int = 1 << 18) -> DataFrame:
    """A table too small for its files to fill the cores (under one scan task) is dealt over them; a larger one is left as it is read, unshuffled."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, size // task_bytes)
    return df.repartition(tasks) if tasks > 1 and size < conf.filesMaxPartitionBytes() else df
