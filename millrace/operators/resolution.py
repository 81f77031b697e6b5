"""Entity resolution: edges from exact keys, owners, fuzzy pairs and decisions; then components.

Records carry ``ord`` (a unique long, the order of "first wins") and brand,
franchisee_name, state. Exact and owner edges are stars around the smallest ord of a
key, one aggregation each. Candidate pairs are a blocked self-join: a block of n rows is
dealt into ceil(n / CHUNK) chunks and each pair of chunks is a key of its own, so a large brand
or state is many joins of bounded size. The distinct names of a block are scored first, and
only accepted pairs of names are expanded into pairs of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import blank, owner_key
from ..functions.similarity import token_set_ratio, token_sort_ratio
from .components import connected_components

# Fixed thresholds.
SAME_BRAND = 82
CROSS_BRAND = 60
AUTO = 96
CHEAP = 85
MIN_CONFIDENCE = 70
#: Rows of a chunk of a block.
CHUNK = 2048


def _low(c: str) -> Column:
    return F.lower(F.trim(blank(F.col(c))))


def _state(c: str) -> Column:
    return F.upper(F.trim(blank(F.col(c))))


def representatives(records: DataFrame) -> DataFrame:
    """First record of each (brand, lower-case name, upper-case state)."""
    best = F.min_by(F.struct(*records.columns), "ord").alias("r")
    return records.groupBy(F.col("brand").alias("k1"), _low("franchisee_name").alias("k2"), _state("state").alias("k3")).agg(best).select("r.*")


def star_edges(records: DataFrame, key: list[Column], kind: str) -> DataFrame:
    """src, dst, kind: each record with the first of its key; nulls in the key drop the record."""
    names = [f"k{i}" for i in range(len(key))]
    keyed = records.select("ord", *(k.alias(n) for k, n in zip(key, names))).na.drop(subset=names)
    first = keyed.groupBy(*names).agg(F.min("ord").alias("src"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return keyed.join(first, names).filter("ord <> src").select("src", F.col("ord").alias("dst"), F.lit(kind).alias("kind"))


def exact_edges(records: DataFrame) -> DataFrame:
    """Same brand, same name but for case."""
    return star_edges(records, [F.col("brand"), _low("franchisee_name")], "exact")


def owner_edges(records: DataFrame) -> DataFrame:
    """Same brand, same person behind the name."""
    return star_edges(records, [F.col("brand"), owner_key(F.col("franchisee_name"))], "owner")


def brand_audit(records: DataFrame) -> DataFrame:
    """Per brand: records, and how many an owner key from parentheses, from the name, or none would group."""
    r = records.withColumn("key", owner_key(F.col("franchisee_name")))
    r = r.withColumn("parens", F.col("key") == F.lower(F.trim(F.regexp_extract("franchisee_name", r"\(([^)]+)\)", 1))))
    return r.groupBy("brand").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("key").isNotNull() & F.col("parens")).alias("grouped_parens"),
        F.count_if(F.col("key").isNotNull() & ~F.col("parens")).alias("grouped_person"),
        F.count_if(F.col("key").isNull()).alias("ungrouped"),
    )


def _meet(side: DataFrame, cols: list[str], by: str, chunk: int) -> DataFrame:
    """k, a_*, b_*: every ordered pair of rows with equal ``k`` once; both sides of a block are dealt by the hash of ``by``."""
    sizes = side.groupBy("k").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    dealt = side.join(sizes, "k").withColumn("mine", F.pmod(F.xxhash64(by), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    a = dealt.select("k", F.col("mine").alias("i"), F.col("other").alias("j"), *(F.col(c).alias(f"a_{c}") for c in cols))
    b = dealt.select("k", F.col("other").alias("i"), F.col("mine").alias("j"), *(F.col(c).alias(f"b_{c}") for c in cols))
    return a.join(b, ["k", "i", "j"]).drop("i", "j")


_COLS = ["ord", "brand", "franchisee_name", "state"]


def _scopes(reps: DataFrame) -> list[tuple[str, DataFrame, Column]]:
    """Scope, records with block ``k``, and what else pairs of a block need: same brand with agreeing or blank states, other brand with the same state."""
    sa, sb = _state("a_state"), _state("b_state")
    return [
        ("same_brand", reps.select(*_COLS, F.col("brand").alias("k")), (sa == sb) | (sa == "") | (sb == "")),
        ("cross_brand", reps.select(*_COLS, _state("state").alias("k")).filter("k <> ''"), F.col("a_brand") != F.col("b_brand")),
    ]


def blocked_pairs(reps: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pairs that blocking lets through, a_ord < b_ord."""
    same, cross = (_meet(side, _COLS, "ord", chunk).filter((F.col("a_ord") < F.col("b_ord")) & rule).drop("k").withColumn("scope", F.lit(scope)) for scope, side, rule in _scopes(reps))
    return same.unionByName(cross)


def candidate_pairs(reps: DataFrame, same: int = SAME_BRAND, cross: int = CROSS_BRAND, chunk: int = CHUNK) -> DataFrame:
    """Blocked pairs at or above their threshold, with ``score``: word-set ratio within a brand, sorted-word ratio across."""
    found = []
    for (scope, side, rule), ratio, least in zip(_scopes(reps), (token_set_ratio, token_sort_ratio), (same, cross)):
        names = side.select("k", F.col("franchisee_name").alias("name")).distinct()
        pairs = _meet(names, ["name"], "name", chunk).filter("a_name <= b_name")
        good = pairs.withColumn("score", ratio("a_name", "b_name")).filter(F.col("score") >= least)
        half = lambda s: side.select(F.col("k"), F.col("franchisee_name").alias(f"{s}_name"), *(F.col(c).alias(f"{s}_{c}") for c in _COLS))  # noqa: E731, B023
        both = good.join(half("a"), ["k", "a_name"]).join(half("b"), ["k", "b_name"])
        # Names are in order, records may not be; two records of one name meet twice.
        both = both.filter(rule & (F.col("a_ord") != F.col("b_ord")) & ((F.col("a_name") != F.col("b_name")) | (F.col("a_ord") < F.col("b_ord"))))
        turn = F.col("a_ord") < F.col("b_ord")
        sides = [F.when(turn, F.col(f"{x}_{c}")).otherwise(F.col(f"{y}_{c}")).alias(f"{x}_{c}") for x, y in (("a", "b"), ("b", "a")) for c in _COLS]
        found.append(both.select(F.lit(scope).alias("scope"), *sides, "score"))
    return found[0].unionByName(found[1])


def pair_keys(pairs: DataFrame) -> DataFrame:
    """Add key_lo, key_hi: the halves ``name:brand:state``, sorted, and pair_key, both joined by a pipe."""
    half = lambda s: F.concat_ws(":", blank(F.col(f"{s}_franchisee_name")), blank(F.col(f"{s}_brand")), blank(F.col(f"{s}_state")))
    out = pairs.withColumn("key_lo", F.least(half("a"), half("b"))).withColumn("key_hi", F.greatest(half("a"), half("b")))
    return out.withColumn("pair_key", F.concat_ws("|", "key_lo", "key_hi"))


def cascade(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Add route (auto, cached, cheap or strong) and accepted; a match of low confidence is no match."""
    d = decisions.groupBy("pair_key").agg(F.max_by("match", "confidence").alias("match"), F.max("confidence").alias("confidence"))
    joined = pair_keys(pairs).join(d, "pair_key", "left")
    route = F.when(F.col("score") >= AUTO, "auto").when(F.col("match").isNotNull(), "cached").when(F.col("score") >= CHEAP, "cheap").otherwise("strong")
    accepted = F.when(F.col("score") >= AUTO, True).otherwise(F.coalesce(F.col("match") & (F.coalesce("confidence", F.lit(100)) >= MIN_CONFIDENCE), F.lit(False)))
    return joined.withColumn("route", route).withColumn("accepted", accepted)


def pending_pairs(routed: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Pairs that wait for a decision, without those the ledger already lists."""
    out = routed.filter(F.col("route").isin("cheap", "strong"))
    return out.join(ledger.select("pair_key"), "pair_key", "left_anti") if ledger is not None else out


def resolve(records: DataFrame, decisions: DataFrame | None = None, auto: bool = True) -> DataFrame:
    """records with ``comp``, the smallest ord of the record's operator. ``auto=False`` leaves the fuzzy pass out."""
    edges = exact_edges(records).unionByName(owner_edges(records)).select("src", "dst")
    if auto or decisions is not None:
        spark = records.sparkSession
        none = spark.createDataFrame([], "pair_key string, match boolean, confidence int")
        routed = cascade(candidate_pairs(representatives(records)), decisions if decisions is not None else none)
        good = routed.filter("accepted" if auto else "accepted and route = 'cached'")
        edges = edges.unionByName(good.select(F.col("a_ord").alias("src"), F.col("b_ord").alias("dst")))
    comps = connected_components(edges)
    return records.join(comps, records["ord"] == comps["node"], "left").withColumn("comp", F.coalesce("component", "ord")).drop("node", "component")


def replay(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Preview: exact and owner edges and accepted decisions only; each half of a decision meets the first record of that half."""
    half = F.concat_ws(":", blank(F.col("franchisee_name")), blank(F.col("brand")), blank(F.col("state")))
    firsts = records.groupBy(half.alias("half")).agg(F.min("ord").alias("ord"))
    good = decisions.filter("match")
    both = good.join(firsts.select(F.col("half").alias("key_lo"), F.col("ord").alias("src")), "key_lo").join(firsts.select(F.col("half").alias("key_hi"), F.col("ord").alias("dst")), "key_hi")
    edges = exact_edges(records).unionByName(owner_edges(records)).select("src", "dst").unionByName(both.select("src", "dst"))
    comps = connected_components(edges)
    return records.join(comps, records["ord"] == comps["node"], "left").withColumn("comp", F.coalesce("component", "ord")).drop("node", "component")
