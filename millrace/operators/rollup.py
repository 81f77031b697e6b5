"""Rollups: one row per operator, tiers, exports and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import blank, first_name, sample_address, search_name

# Fixed values of the tiers and their export.
TIER_A = (16, 200)
TIER_B = (5, 15)
SEQUENCES = {"A": "tier_a", "B": "tier_b"}
CONTACT_COLUMNS = ("apollo_company", "apollo_email", "apollo_linkedin", "apollo_title")
MESSAGING = {"A": "Has management layers; many locations.", "B": "Founder-led; few locations."}


def _some(c: str) -> Column:
    return F.when(blank(F.col(c)) != "", F.col(c))


def _roll(records: DataFrame, key: str, address: Column) -> DataFrame:
    """Shared aggregate: longest name, sets, units, most frequent state, first phone and address; two narrow shuffles on the key."""
    by_state = records.groupBy(key, F.col("state").alias("s_")).agg(F.count("*").alias("n_"), F.min("ord").alias("o_")).filter("coalesce(s_, '') <> ''")
    modes = by_state.groupBy(key).agg(F.max_by("s_", F.struct("n_", -F.col("o_"))).alias("primary_state"))
    rolled = records.groupBy(key).agg(
        F.max_by("franchisee_name", F.struct(F.length("franchisee_name"), -F.col("ord"))).alias("franchisee_name"),
        F.array_sort(F.collect_set("franchisee_name")).alias("names"),
        F.count("*").cast("int").alias("total_units"),
        F.array_sort(F.collect_set(_some("brand"))).alias("brands"),
        F.array_sort(F.collect_set(_some("state"))).alias("states"),
        F.min_by(_some("restaurant_phone"), F.when(_some("restaurant_phone").isNotNull(), F.col("ord"))).alias("restaurant_phone"),
        F.min_by(address, F.when(_some("raw_address").isNotNull(), F.col("ord"))).alias("sample_address"),
        F.min("ord").alias("first_ord"),
    )
    return rolled.join(modes, key, "left").select(
        key,
        "franchisee_name",
        F.when(F.size("names") > 1, F.array_join("names", " / ")).otherwise("").alias("name_variants"),
        "total_units",
        F.array_join("brands", " | ").alias("brands_operated"),
        F.size("brands").alias("brand_count"),
        F.when(F.size("brands") > 1, "Yes").otherwise("No").alias("is_multi_brand"),
        blank(F.col("primary_state")).alias("primary_state"),
        F.array_join("states", " | ").alias("all_states"),
        F.size("states").alias("state_count"),
        blank(F.col("restaurant_phone")).alias("restaurant_phone"),
        blank(F.col("sample_address")).alias("sample_address"),
        "first_ord",
    )


def operators(resolved: DataFrame) -> DataFrame:
    """One row per ``comp``; order by total_units descending, first_ord for ties."""
    return _roll(resolved, "comp", F.col("raw_address")).withColumns({c: F.lit("") for c in CONTACT_COLUMNS})


def care_operators(records: DataFrame) -> DataFrame:
    """One row per lower-case name whatever the brand, with a formatted address; order by units descending, then name."""
    keyed = records.withColumn("name_key", F.lower(F.trim(blank(F.col("franchisee_name")))))
    return _roll(keyed, "name_key", sample_address(F.col("raw_address"), F.col("city"), F.col("state"), F.col("zip")))


def tier_of(units: Column) -> Column:
    """A, B, large or small; null for what is not an integer."""
    n = F.expr(f"try_cast({units} as int)") if isinstance(units, str) else units.try_cast("int")
    return F.when(n.between(*TIER_A), "A").when(n.between(*TIER_B), "B").when(n > TIER_A[1], "large").when(n.isNotNull(), "small")


def icp_rows(ops: DataFrame, sequences: dict[str, str] = SEQUENCES, messaging: dict[str, str] = MESSAGING) -> DataFrame:
    """Rows of tier A and B with outreach columns; the texts per tier are the caller's."""
    tier = tier_of(F.col("total_units"))
    pick = lambda values: F.when(F.col("tier") == "A", values["A"]).otherwise(values["B"])
    out = ops.withColumn("tier", tier).filter(F.col("tier").isin("A", "B"))
    brand = F.element_at(F.split("brands_operated", r" \| "), 1)
    hint = F.concat_ws(" ", search_name(F.col("franchisee_name")), brand, F.lit("franchisee"), "primary_state")
    return out.select("franchisee_name", "name_variants", first_name(F.col("franchisee_name")).alias("first_name"), "total_units", "brands_operated", "brand_count", "is_multi_brand", "primary_state", "all_states", "tier", pick(sequences).alias("instantly_sequence"), pick(messaging).alias("messaging_note"), hint.alias("apollo_search_hint"), *(F.lit("").alias(c) for c in CONTACT_COLUMNS), "restaurant_phone", "sample_address")


def by_shape(names: DataFrame, name: str) -> DataFrame:
    """Names and spellings by kind: blank (counted as company), with parentheses, plain."""
    n = F.trim(F.col(name))
    shaped = names.select(n.alias("n"), F.when(n == "", "company").when(n.contains("("), "paren").otherwise("plain").alias("shape"))
    return shaped.groupBy("shape").agg(F.count("*").alias("names"), F.countDistinct(F.lower("n")).alias("spellings"))


def histogram(ops: DataFrame) -> DataFrame:
    """Operators and multi-brand operators by size bucket."""
    n = F.col("total_units")
    bucket = F.when(n < 5, "1-4").when(n <= 15, "5-15").when(n <= 200, "16-200").otherwise("201+")
    return ops.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("operators"), F.count_if(F.col("is_multi_brand") == "Yes").alias("multi_brand"))


def file_summary(records: DataFrame) -> DataFrame:
    """Records by brand and file, with a total row of nulls."""
    return records.rollup("brand", "file").agg(F.count("*").alias("records"), F.grouping_id().alias("level")).filter("level in (0, 3)").drop("level")


def latency_stats(calls: DataFrame, group: str, value: str) -> DataFrame:
    """Count, min, max, mean and interpolated 50th, 90th and 95th percentiles per group."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.95)))
    return calls.groupBy(group).agg(F.count("*").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("avg"), p.alias("p")).select(group, "n", "min", "max", "avg", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p95"))
