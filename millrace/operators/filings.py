"""Choosing a filing among search results of several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import blank
from ..functions.similarity import direct_ratio, filing_ratio
from .derive import any_date, rank_in

# Document types by priority and score floors.
FILING_TYPES = ("Clean FDD", "Final FDD", "Marked FDD")
FLOORS = {"wi": 0.35, "mn": 0.25}


def _type_rank(c: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, FILING_TYPES)), c)


def pick_wisconsin(items: DataFrame) -> DataFrame:
    """Best usable item per request: name score, registered, effective date; ord breaks ties last-first as a descending stable sort keeps the first."""
    usable = items.filter(F.col("fddAvailable") & (blank(F.col("fddPdfUrl")) != ""))
    scored = usable.withColumn("score", filing_ratio("requested", F.concat_ws(" ", blank(F.col("tradeName")), blank(F.col("legalName")))))
    order = [F.col("score").desc(), (F.lower(blank(F.col("status"))) == "registered").desc(), any_date(F.col("effectiveDate")).desc_nulls_last(), F.col("ord")]
    return rank_in(scored, ["requested"], order).select("requested", F.col("fddPdfUrl").alias("url"), F.col("legalName").alias("label"), F.col("fileNumber").alias("file_id"), "score")


def pick_minnesota(items: DataFrame) -> DataFrame:
    """Best filing of a known type per request: name score, type, received date, year."""
    usable = items.filter((blank(F.col("documentUrl")) != "") & F.col("documentType").isin(*FILING_TYPES))
    scored = usable.withColumn("score", filing_ratio("requested", F.concat_ws(" ", blank(F.col("franchiseName")), blank(F.col("franchisor")))))
    order = [F.col("score").desc(), _type_rank(F.col("documentType")), any_date(F.col("receivedDate")).desc_nulls_last(), blank(F.col("year").cast("string")).desc(), F.col("ord")]
    return rank_in(scored, ["requested"], order).select("requested", F.col("documentUrl").alias("url"), F.col("franchisor").alias("label"), F.col("fileNumber").alias("file_id"), "score")


def pick_california(items: DataFrame, fields: str = "fields") -> DataFrame:
    """First field of the first item (by ord) that looks like a document link; ``fields`` is a map column."""
    entries = items.select("requested", "ord", F.posexplode(F.map_entries(fields)).alias("pos", "e")).select("requested", "ord", "pos", F.col("e.key").alias("k"), F.col("e.value").alias("v"))
    k, v = F.lower("k"), F.lower("v")
    links = entries.filter(v.startswith("http") & (v.endswith(".pdf") | k.contains("pdf") | k.contains("document") | k.contains("fdd")))
    return rank_in(links, ["requested"], [F.col("ord"), F.col("pos")]).select("requested", F.col("v").alias("url"))


def pick_direct(rows: DataFrame, floor: float = FLOORS["mn"]) -> DataFrame:
    """Best row per request: strictly higher score, or equal score and higher type; rows under the floor go."""
    scored = rows.withColumn("score", direct_ratio("requested", "name")).filter(F.col("score") >= floor)
    return rank_in(scored, ["requested"], [F.col("score").desc(), F.coalesce(F.nullif(_type_rank(F.col("documentType")), F.lit(0)), F.lit(99)), F.col("ord")])


def first_source(tries: DataFrame, order: tuple[str, ...] = ("wi", "mn", "ca")) -> DataFrame:
    """Per request: the first source in order with a url, and the notes of all sources tried up to it."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    seen = tries.withColumn("at", at).groupBy("requested").agg(F.min(F.when(blank(F.col("url")) != "", F.struct("at", "source", "url"))).alias("best"), F.array_sort(F.collect_list(F.struct("at", "note"))).alias("notes"))
    used = F.filter("notes", lambda x: F.col("best").isNull() | (x["at"] <= F.col("best.at")))
    return seen.select("requested", F.col("best.source").alias("source"), F.col("best.url").alias("url"), F.array_join(F.filter(F.transform(used, lambda x: blank(x["note"])), lambda x: x != ""), "; ").alias("notes"))
