"""Ordered operators on lines and pages of documents. Each partitions by document, never globally."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import blank

# Parameters, markers and patterns that results depend on.
DENSE, MAX_GAP, PAD, MIN_TOTAL = 5, 2, 1, 20
TRIM_MARKERS = ("TRANSFERRED, TERMINATED", "LIST OF FRANCHISEES WHO TRANSFERRED", "DID NOT RENEW", "TRANSFERS – STILL FRANCHISEES", "TRANSFERS - STILL FRANCHISEES", "FRANCHISES TERMINATED, CANCELED", "FRANCHISED BUSINESS NOT YET OPENED", "LIST OF FRANCHISEES WHO HAVE LEFT", "OUTLET NOT OPEN AS OF")
SECTION_END = (r"EXHIBIT\s+[S-Z]\b", r"SCHEDULE\s+[B-Z]\b", r"ATTACHMENT\s+[2-9]\b", r"^ITEM\s+\d+\b", "FRANCHISE AGREEMENT", "OPERATIONS MANUAL", "FINANCIAL STATEMENTS")
BATCH, HOP, HOP_STEP, CHUNK = 250, 100, 50, 800


def lines_of(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, line_no (from 0), text: one row per line."""
    return docs.select(doc, F.posexplode(F.split(blank(F.col(text)), "\n")).alias("line_no", "text")).withColumn("line_no", F.col("line_no").cast("long"))


def page_runs(pages: DataFrame, dense: int = DENSE, max_gap: int = MAX_GAP) -> DataFrame:
    """doc_id, start_page, end_page, total of each run of dense pages; up to ``max_gap`` lean pages lie inside a run."""
    order = Window.partitionBy("doc_id").orderBy("page_no")
    summed = pages.withColumn("before", F.sum("score").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("score"))
    hot = summed.filter(F.col("score") >= dense)
    opens = F.coalesce((F.col("page_no") - F.lag("page_no").over(order) > max_gap + 1).cast("int"), F.lit(1))
    runs = hot.withColumn("run", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "run").agg(F.min("page_no").alias("start_page"), F.max("page_no").alias("end_page"), F.max(F.col("before") + F.col("score")).alias("hi"), F.min("before").alias("lo")).select("doc_id", "start_page", "end_page", (F.col("hi") - F.col("lo")).alias("total"))


def densest_run(pages: DataFrame, dense: int = DENSE, max_gap: int = MAX_GAP, pad: int = PAD, min_total: int = MIN_TOTAL) -> DataFrame:
    """The run with the largest total of each document, first on ties, padded and clamped; none under ``min_total``."""
    best = page_runs(pages, dense, max_gap).groupBy("doc_id").agg(F.max_by(F.struct("start_page", "end_page", "total"), F.struct("total", -F.col("start_page"))).alias("b")).select("doc_id", "b.*").filter(F.col("total") >= min_total)
    last = pages.groupBy("doc_id").agg(F.max("page_no").alias("last"))
    return best.join(last, "doc_id").select("doc_id", F.greatest(F.lit(1), F.col("start_page") - pad).cast("int").alias("start_page"), F.least("last", F.col("end_page") + pad).cast("int").alias("end_page"), "total")


def tumbling(lines: DataFrame, size: int = BATCH) -> DataFrame:
    """Add ``batch``: consecutive batches of ``size`` lines."""
    return lines.withColumn("batch", F.floor(F.col("line_no") / size).cast("long"))


def hopping(lines: DataFrame, size: int = HOP, step: int = HOP_STEP) -> DataFrame:
    """Add ``batch``, a row for every batch a line is in: batches of ``size`` lines start every ``step``."""
    last = F.floor(F.col("line_no") / step)
    first = F.greatest(F.lit(0), F.floor((F.col("line_no") - size) / step) + 1)
    return lines.withColumn("batch", F.explode(F.sequence(first.cast("long"), last.cast("long"))))


def skip_thin(batches: DataFrame, least: int = 50) -> DataFrame:
    """doc_id, batch, lines, chars of batches whose joined, trimmed text has ``least`` characters."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda s: s["text"]), "\n")
    return batches.groupBy("doc_id", "batch").agg(F.count("*").alias("lines"), F.length(F.regexp_replace(text, r"^\s+|\s+$", "")).cast("long").alias("chars")).filter(F.col("chars") >= least)


def forward_fill(df: DataFrame, value: str, key: list[str], order: str, out: str) -> DataFrame:
    """Blank values take the last non-blank one before them."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, blank(F.last(F.when(blank(F.col(value)) != "", F.col(value)), ignorenulls=True).over(w)))


def take_while(lines: DataFrame, markers: tuple[str, ...] = TRIM_MARKERS) -> DataFrame:
    """Lines before the document's first line that holds any marker."""
    hit = reduce(lambda a, b: a | b, (blank(F.col("text")).contains(m) for m in markers))
    first = F.min(F.when(hit, F.col("line_no"))).over(Window.partitionBy("doc_id"))
    return lines.withColumn("stop_", first).filter(F.col("stop_").isNull() | (F.col("line_no") < F.col("stop_"))).drop("stop_")


def section_end(lines: DataFrame, starts: DataFrame, patterns: tuple[str, ...] = SECTION_END, skip: int = 10, reach: int = 40_000) -> DataFrame:
    """doc_id, start, end: the first short non-blank line from start + skip that matches a pattern, else the end of reach or document."""
    t = F.upper(F.trim(blank(F.col("text"))))
    inside = F.col("line_no").between(F.col("start") + skip, F.col("start") + reach - 1)
    hit = inside & (F.length(t) > 0) & (F.length(t) < 80) & t.rlike("|".join(f"(?:{p})" for p in patterns))
    return lines.join(starts.select("doc_id", "start"), "doc_id").groupBy("doc_id", "start").agg(F.min(F.when(hit, F.col("line_no"))).alias("m"), (F.max("line_no") + 1).alias("n")).select("doc_id", "start", F.coalesce("m", F.least(F.col("start") + reach, F.col("n"))).alias("end"))


def section_start(lines: DataFrame, keyword: Column | str) -> DataFrame:
    """doc_id, start: the first short line that holds the keyword in any case; the keyword has over 3 characters."""
    k = F.lit(keyword) if isinstance(keyword, str) else keyword
    t = F.trim(blank(F.col("text")))
    hit = (F.length(k) > 3) & (F.length(t) < 100) & F.upper(t).contains(F.upper(k))
    return lines.groupBy("doc_id").agg(F.min(F.when(hit, F.col("line_no"))).alias("start")).filter("start is not null")


def first_accepted_chunk(lines: DataFrame, verdicts: DataFrame, size: int = CHUNK, least: int = 85, back: int = 20) -> DataFrame:
    """doc_id, start: the first chunk accepted with enough confidence, backed up some lines."""
    chunks = lines.select("doc_id", F.floor(F.col("line_no") / size).cast("long").alias("chunk")).distinct()
    good = chunks.join(verdicts.filter(F.col("found") & (F.col("confidence") >= least)), ["doc_id", "chunk"])
    return good.groupBy("doc_id").agg(F.min("chunk").alias("chunk")).select("doc_id", F.greatest(F.lit(0), F.col("chunk") * size - back).cast("long").alias("start"))


def last_lines_hold(lines: DataFrame, marker: str, n: int = 40) -> DataFrame:
    """doc_id, found: one of the last n lines holds the marker."""
    w = Window.partitionBy("doc_id").orderBy(F.col("line_no").desc())
    return lines.withColumn("rn_", F.row_number().over(w)).filter(F.col("rn_") <= n).groupBy("doc_id").agg(F.max(blank(F.col("text")).contains(marker)).alias("found"))


def cover_brand(lines: DataFrame, verdicts: DataFrame, brands: DataFrame, n: int = 60) -> DataFrame:
    """doc_id, brand: what a verdict on the cover says, else the first brand, by name, that the first n lines name; null if none.

    ``verdicts`` (doc_id, brand) are answers of outside knowledge; ``brands`` (name) is the catalogue.
    """
    cover = lines.filter(F.col("line_no") < n).select("doc_id", F.lower(blank(F.col("text"))).alias("t"))
    named = cover.join(brands.select("name"), F.contains("t", F.lower("name"))).groupBy("doc_id").agg(F.min("name").alias("found"))
    docs = lines.select("doc_id").distinct()
    said = verdicts.filter(blank(F.col("brand")) != "").groupBy("doc_id").agg(F.min("brand").alias("said"))
    return docs.join(said, "doc_id", "left").join(named, "doc_id", "left").select("doc_id", F.coalesce("said", "found").alias("brand"))


def section_holds(sections: DataFrame, verdicts: DataFrame) -> DataFrame:
    """sections with ``holds``: the yes or no of a verdict; true where there is none or it is inconclusive."""
    said = verdicts.groupBy("doc_id").agg(F.min(F.when(F.lower(F.trim("answer")).isin("yes", "no"), F.lower(F.trim("answer")))).alias("said_"))
    return sections.join(said, "doc_id", "left").withColumn("holds", F.coalesce(F.col("said_") == "yes", F.lit(True))).drop("said_")
