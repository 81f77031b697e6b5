"""Keep a run going until it is done, and see how far it is."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import QUOTA_MARKERS

# Attempts, waits in seconds, and the time allowed in all.
ATTEMPTS, QUOTA_WAIT, RETRY_WAIT, WALL = 60, 600, 120, 24 * 3600


def until_done(run: Callable[[], bool], attempts: int = ATTEMPTS, quota_wait: float = QUOTA_WAIT, retry_wait: float = RETRY_WAIT, wall: float = WALL, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> int:
    """Call ``run`` until it returns true; the number of attempts it took.

    A failure whose text names a quota waits ``quota_wait``, any other failure or unfinished run ``retry_wait``.
    What a run has finished stays (checkpoints, versioned tables), so an attempt goes on where the last one broke.
    """
    began, last = clock(), "not done"
    for attempt in range(1, attempts + 1):
        wait = retry_wait
        try:
            if run():
                return attempt
        except Exception as problem:  # every failure is reported and tried again
            last = str(problem)
            wait = quota_wait if any(m in last.lower() for m in QUOTA_MARKERS) else retry_wait
            print(f"attempt {attempt}: {last}")
        if attempt < attempts:
            if clock() - began + wait > wall:
                break
            sleep(wait)
    raise TimeoutError(f"not done after {attempt} attempts: {last}")


def progress_view(todo: DataFrame, done: DataFrame, group: str, key: str = "doc_id") -> DataFrame:
    """group, total, finished, share: how far each group is, from the tables of state; it can be asked while a run goes on."""
    marked = todo.select(group, key).join(done.select(key).distinct().withColumn("done_", F.lit(1)), key, "left")
    counted = marked.groupBy(group).agg(F.count("*").alias("total"), F.count("done_").alias("finished"))
    return counted.withColumn("share", F.round(F.col("finished") / F.col("total"), 4))
