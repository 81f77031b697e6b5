"""Where outside knowledge enters: decisions about pairs, classes of names, text of documents.

The engine ships none that calls a service. A provider is handed a DataFrame of open
questions and returns answers as a DataFrame, so a table, a rule or a batched function
can stand behind it, and answers can be kept and joined on the next run.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a document to the text of its pages.
TextExtractor = Callable[[bytes], list[str]]


class DecisionProvider(Protocol):
    """Answers for pending pairs: pair_key, match, confidence, reason."""

    def decide(self, pending: DataFrame) -> DataFrame: ...


class TableDecisions:
    """Answers from a kept table; pairs it does not know stay open."""

    def __init__(self, table: DataFrame):
        self.table = table

    def decide(self, pending: DataFrame) -> DataFrame:
        """Rows of the table for the pending pairs."""
        return self.table.join(pending.select("pair_key").distinct(), "pair_key", "left_semi")


class ThresholdDecisions:
    """Accepts pairs from a score on; a stand-in where no decisions are kept."""

    def __init__(self, least: int = 90):
        self.least = least

    def decide(self, pending: DataFrame) -> DataFrame:
        """A decision for every pending pair, its score as the confidence."""
        return pending.select("pair_key", (F.col("score") >= self.least).alias("match"), F.col("score").cast("int").alias("confidence"), F.lit("score").alias("reason"))


def settle(pairs: DataFrame, known: DataFrame, provider: DecisionProvider) -> DataFrame:
    """Known decisions and the provider's answers for the pairs still open."""
    from ..operators.resolution import cascade, pending_pairs

    open_ = pending_pairs(cascade(pairs, known))
    columns = ["pair_key", "match", "confidence"]
    return known.select(*columns).unionByName(provider.decide(open_).select(*columns))
