"""Registry lookup: inputs and their name variants against bulk records, best match and alternates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from ..functions.names import blank, name_variants, normalize_for_similarity
from ..functions.similarity import jaccard, tokens
from ..session import once


def lookup_table(inputs: DataFrame) -> DataFrame:
    """norm, entity_name, query, rank: one row per normalised query; the first input, then its first query, wins."""
    # Names repeat (a chain's owner at every place): each is simplified and normalised once.
    named = inputs.filter(F.trim(blank(F.col("entity_name"))) != "").groupBy(F.trim("entity_name").alias("entity_name")).agg(F.min("ord").alias("ord"))
    queries = named.select("ord", "entity_name", F.posexplode(F.concat(F.array("entity_name"), name_variants(F.col("entity_name")))).alias("rank", "query"))
    queries = queries.withColumn("norm", normalize_for_similarity(F.col("query"))).filter("norm <> ''")
    return queries.groupBy("norm").agg(F.min_by(F.struct("entity_name", "query", "rank"), F.struct("ord", "rank")).alias("q")).select("norm", "q.*")


def similar_names(inputs: DataFrame) -> DataFrame:
    """The lookup table with ``name_similarity``, which depends on the input and the normalised name alone, so it is not computed for every record."""
    return lookup_table(inputs).withColumn("name_similarity", jaccard(tokens(normalize_for_similarity(F.col("entity_name"))), tokens(F.col("norm"))))


def match(look: DataFrame, registry: DataFrame, name: Column) -> DataFrame:
    """Registry records with the input they match: an equi-join on the normalised name."""
    return registry.withColumn("norm", once(normalize_for_similarity(name))).filter("norm <> ''").join(look, "norm")


def match_all(inputs: DataFrame, registry: DataFrame, name: Column) -> DataFrame:
    """Registry records with the input they match and ``name_similarity``; the small side is broadcast if adaptive execution finds it small."""
    return match(similar_names(inputs), registry, name)


def top(c: Column, n: int) -> Column:
    """The n least values of a group, in order. A group holds n values, never its rows, and nothing is sorted by key beforehand while a task sees few groups."""
    return InternalFunction.collect_top_k(c, n, True)


def _place(score: str, order: str, *more: Column) -> Column:
    """A struct that sorts by score, best first and null last, then order."""
    return F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("down"), F.col(order).alias("at"), *more)


def best_and_alternates(candidates: DataFrame, key: str, score: str, order: str, alternate: dict[str, Column], n: int = 5) -> DataFrame:
    """key, ``order`` of its best row by score, then order, ``match_count`` and ``alternates`` (the next n as an array of structs), from one pass that keeps n + 1 short structs of a key."""
    each = _place(score, order, F.struct(*(c.alias(k) for k, c in alternate.items())).alias("alt"))
    got = candidates.groupBy(key).agg(top(each, n + 1).alias("top_"), F.count("*").alias("match_count"))
    rest = F.transform(F.slice("top_", 2, n), lambda s: s["alt"])
    return got.select(key, F.col("top_")[0]["at"].alias(order), "match_count", F.when(F.size("top_") > 1, rest).alias("alternates"))


def best_rows(candidates: DataFrame, key: str, score: str, order: str) -> DataFrame:
    """The whole best row of each key by score, then order; equal ones by their other columns."""
    body = F.struct(*(c for c in candidates.columns if c != key)).alias("row")
    return candidates.groupBy(key).agg(top(_place(score, order, body), 1)[0]["row"].alias("best_")).select(key, "best_.*")


def sieve(column: Column, values: DataFrame, bits: int = 1 << 17) -> Column:
    """Holds for every row whose value is among those of a one-column table, and by chance for n in ``bits`` of the others.

    It goes before the exact semi-join: Spark moves a filter, not a join, below columns that are costly to build.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)).cast("int")
    at = values.select(slot(values[values.columns[0]]).alias("slot"))
    rows = at.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("set")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["set"]
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    mine = slot(column)
    return F.getbit(F.get(table, F.shiftright(mine, 6)), mine.bitwiseAND(F.lit(63))) == 1


def complete(inputs: DataFrame, best: DataFrame, key: str = "entity_name") -> DataFrame:
    """Every input row with its match; those without get match_count 0 and their name as the query tried."""
    out = inputs.join(best, key, "left")
    return out.withColumn("match_count", F.coalesce("match_count", F.lit(0))).withColumn("query_used", F.coalesce("query", key) if "query" in best.columns else F.col(key))


def fuzzy_fallback(inputs: DataFrame, registry: DataFrame, name: str, threshold: float = 0.5) -> DataFrame:
    """Name then variants until one matches; for inputs with none, records with the same first token and enough similarity."""
    reg = registry.withColumn("norm", normalize_for_similarity(F.col(name))).filter("norm <> ''")
    tried = inputs.select("ord", "entity_name", F.posexplode(F.concat(F.array("entity_name"), name_variants(F.col("entity_name")))).alias("rank", "query")).withColumn("norm", normalize_for_similarity(F.col("query"))).filter("norm <> ''")
    hits = tried.join(reg, "norm")
    first = hits.groupBy("ord").agg(F.min("rank").alias("rank"))
    exact = hits.join(first, ["ord", "rank"]).select("ord", "entity_name", F.col(name).alias("found"), F.col("query").alias("label"))
    left = inputs.join(first.select("ord"), "ord", "left_anti").withColumn("n1", normalize_for_similarity(F.col("entity_name"))).withColumn("tok", F.element_at(F.split("n1", " "), 1))
    near = left.filter("tok <> ''").join(reg.withColumn("tok", F.element_at(F.split("norm", " "), 1)), "tok").filter(jaccard(tokens(F.col("n1")), tokens(F.col("norm"))) >= threshold)
    return exact.unionByName(near.select("ord", "entity_name", F.col(name).alias("found"), F.concat(F.lit("FUZZY:"), "tok").alias("label")))


def first_variant(inputs: DataFrame, found: DataFrame, keep_ord: bool = False) -> DataFrame:
    """entity_name, query, attempts (and ord): the first query of the ladder that found something, and the queries tried up to it."""
    tried = inputs.select("ord", "entity_name", F.posexplode(F.concat(F.array("entity_name"), name_variants(F.col("entity_name")))).alias("rank", "query"))
    hit = tried.join(found.select("query").distinct().withColumn("hit", F.lit(True)), "query", "left")
    firsts = hit.groupBy("ord", "entity_name").agg(F.min(F.when(F.col("hit"), F.col("rank"))).alias("at"), F.array_sort(F.collect_list(F.struct("rank", "query"))).alias("all"))
    used = F.filter("all", lambda q: F.col("at").isNull() | (q["rank"] <= F.col("at")))
    return firsts.select(*(["ord"] if keep_ord else []), "entity_name", F.when(F.col("at").isNotNull(), F.element_at(F.transform("all", lambda q: q["query"]), (F.col("at") + 1).cast("int"))).otherwise(F.lit("")).alias("query"), F.array_join(F.transform(used, lambda q: q["query"]), " | ").alias("attempts"))


def not_done(inputs: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Inputs with a name that no finished row (with fetched_at) has; 0 or None is no limit."""
    k = F.lower(F.trim(blank(F.col("entity_name"))))
    finished = done.filter(blank(F.col("fetched_at")) != "").select(k.alias("k_")).distinct()
    out = inputs.withColumn("k_", k).filter("k_ <> ''").join(finished, "k_", "left_anti").drop("k_")
    return out.orderBy("ord").limit(limit) if limit else out


def backfill(rows: DataFrame, answers: DataFrame, key: Column) -> DataFrame:
    """Rename rows whose group has a confident answer with a source: ``Company (Name)``."""
    good = answers.filter((F.trim(blank(F.col("company"))) != "") & (F.upper(F.trim("company")) != "NONE") & (F.upper("confidence") == "HIGH") & (F.trim(blank(F.col("source_url"))) != ""))
    good = good.groupBy("key").agg(F.min("company").alias("company_"))
    out = rows.withColumn("key", key).join(good, "key", "left")
    return out.withColumn("franchisee_name", F.when(F.col("company_").isNotNull(), F.format_string("%s (%s)", "company_", "franchisee_name")).otherwise(F.col("franchisee_name"))).drop("key", "company_")
