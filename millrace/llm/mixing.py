"""Mixing sources to target weights by systematic sampling (operator 5), native.

A source's target is its weight's share of all words, but at most ``most`` times its
own; the excess goes to the others by weight (water filling over sources). With rate
r = target / size, each of its documents expects r copies. Documents lie in order of
size class, then hash, so that a stretch of the running sum holds like documents; the
running sum of expected copies plus one random offset per source is emitted once per
integer it passes, so a document has floor(r) or ceil(r) copies, never over ``most``.

The running sum is two-level: documents are counted in cells (source, size class, hash
prefix), cells are summed over, and ranks are taken within a cell. A source that holds
a third of all rows is spread over thousands of cells.

Defined results: null text has size 0; null sources form one source, ordered last;
sources of size 0 take nothing; equal rows are interchangeable; reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import WORD, row_hash, whole

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"
#: Hex digits of the hash that split a size class of a source into cells.
CELL_DIGITS = 2


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``: one row per source, two global sorts of that small table."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("double")).withColumn("cap", most * F.col("source_size").cast("double"))
    # Caps bind in order of cap / weight: the first k are capped at the level where the rest fits.
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    leveled = weighed.withColumn("level", level).withColumn("at", F.row_number().over(full))
    # The first source in that order that its level does not cap settles the level of all.
    settled = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("at", "level"))).over(every)["level"]
    return leveled.withColumn("settled", settled).select("source", "source_size", F.least(F.col("cap"), F.col("w") * F.col("settled")).alias("target"))


def _hash() -> Column:
    """The place of a document within its size class."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))


def _key(docs: DataFrame) -> Column:
    """A key that only equal rows share."""
    return F.md5(F.concat(_hash(), F.col("text").isNull().cast("string"), F.hex(row_hash(docs, ("text",)))).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key, and the order of sampling: size class (leading bits of the size), then hash."""
    bits = F.bin(F.col("size") + 1)
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"), _hash().alias("h"), _key(docs).alias("key")).withColumn("size_class", F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4)))


def systematic_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies for every row of docs."""
    slim = cut(sized(docs).withColumn("cell", F.substring("h", 1, CELL_DIGITS)).withColumn("name", F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source"))))
    cells = slim.groupBy("name", "size_class", "cell").agg(F.first("source", ignorenulls=True).alias("source"), F.count("*").alias("n"), F.sum("size").alias("words"))
    aims = targets(cells.groupBy("name").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("words").alias("source_size")).drop("name"), weights, most)
    aims = aims.withColumn("name", F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source"))).drop("source")
    before = cells.select("name", "size_class", "cell", F.coalesce(F.sum("n").over(Window.partitionBy("name").orderBy("size_class", "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    before = before.join(aims, "name")
    ranked = slim.withColumn("rank", F.row_number().over(Window.partitionBy("name", "size_class", "cell").orderBy("h", "doc_id", "key")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "name").cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    passed = F.floor(F.col("offset") + F.col("rate") * F.col("r")) - F.floor(F.col("offset") + F.col("rate") * (F.col("r") - 1))
    out = ranked.join(before, ["name", "size_class", "cell"]).withColumn("r", F.col("before") + F.col("rank")).withColumn("rate", rate).withColumn("offset", offset)
    return out.select("doc_id", "source", "key", "size", "source_size", "target", F.least(passed, F.lit(int(most))).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The mixed table: every column of docs as it was, each row as often as the mix takes it.

    Rows equal in every column share the sum of their copies; they meet before the shuffle. The
    texts are shuffled once, by a key of the whole row; the copies meet them there.
    """
    taken = systematic_copies(docs, weights, most, seed).filter("copies > 0").groupBy("key").agg(F.sum("copies").alias("copies"))
    once = docs.select(_key(docs).alias("key"), whole(docs).alias("row")).groupBy("key").agg(F.first("row").alias("row"))
    return once.join(taken, "key").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS h FROM documents),
classed AS (
  SELECT *, lpad(length(bin(size + 1))::VARCHAR, 2, '0') || substr(bin(size + 1), 1, 4) AS size_class,
         CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS name FROM sized),
per_source AS (SELECT source, name, sum(size)::BIGINT AS source_size FROM classed GROUP BY 1, 2),
weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM per_source),
leveled AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
settled AS (SELECT level AS settled FROM leveled WHERE level * w <= cap ORDER BY cap / w, source ASC NULLS LAST LIMIT 1),
aims AS (SELECT name, source_size, least(cap, w * settled) AS target FROM leveled, settled),
ranked AS (
  SELECT c.*, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}' || c.name), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS off,
         row_number() OVER (PARTITION BY c.name ORDER BY c.size_class, c.h, c.doc_id) AS r
  FROM classed c JOIN aims a USING (name))
SELECT doc_id, size, source_size, target, (least(floor(off + rate * r) - floor(off + rate * (r - 1)), 3) * size)::BIGINT AS taken FROM ranked
"""
