"""Registry enrichment: inputs to their best record, derived columns and signals, per state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import blank, strip_status
from ..functions.similarity import score_ca, score_co, score_fl, score_ny, score_tx
from ..operators.derive import PREFIX, california, colorado, florida, new_york, shared_signals, texas, universal
from ..operators.lookup import best_and_alternates, best_rows, complete, match, sieve, similar_names
from ..session import cut, many_groups, measured

_c = F.col


def _scored(state: str, m: DataFrame) -> tuple[Column, Column, Column, str]:
    """Score, name and number of a matched record, and the column that identifies it."""
    name, known = _c("entity_name"), _c("name_similarity")
    if state == "fl":
        return score_fl(name, _c("name"), _c("status"), _c("filing_type"), known), _c("name"), _c("entity_number"), "entity_number"
    if state == "ny":
        return score_ny(name, _c("current_entity_name"), _c("jurisdiction"), _c("initial_dos_filing_date"), known), _c("current_entity_name"), _c("dos_id"), "dos_id"
    if state == "co":
        return score_co(name, _c("entityname"), _c("entitystatus"), _c("entitytype"), _c("entityformdate"), known), strip_status(_c("entityname")), _c("entityid"), "entityid"
    if state == "tx":
        return score_tx(name, _c("name"), known), _c("name"), _c("taxpayer_number"), "taxpayer_number"
    return score_ca(name, _c("first_result_name"), _c("status"), _c("entity_type"), _c("jurisdiction"), _c("formation_date"), known), _c("first_result_name"), _c("entity_number"), "entity_number"


#: The column of a state's records that holds the entity name.
NAME = {"fl": "name", "ny": "current_entity_name", "co": "entityname", "tx": "name", "ca": "first_result_name"}
BUILD = {"fl": florida, "ny": new_york, "co": colorado, "tx": texas, "ca": california}


def best_matches(inputs: DataFrame, registry: DataFrame, state: str) -> DataFrame:
    """One row per matched input: the best record, its score and similarity, and five alternates.

    A first pass of the registry counts and ranks short columns only; a second reads whole the records that are some
    input's best, so no wide row is kept, sorted or parsed that is not in the result.
    """
    name = strip_status(_c(NAME[state])) if state == "co" else _c(NAME[state])
    look = measured(similar_names(inputs))

    def scored(records: DataFrame) -> tuple[DataFrame, Column, Column, str]:
        found = match(look, records, name)
        score, label, number, order = _scored(state, found)
        return found.withColumn("score", score), label, number, order

    found, label, number, order = scored(registry)
    alternate = {"name": label, "num": number, **({"status": _c("status")} if state in ("fl", "ca") else {}), "score": F.bround("score", 2)}
    with many_groups(registry.sparkSession):
        ranked = cut(best_and_alternates(found, "entity_name", "score", order, alternate))
    ids = measured(ranked.select(order).distinct())
    # Records that share a best one's identifier come along; ranking them again leaves the best.
    same = registry.filter(sieve(registry[order], ids)).join(ids, registry[order].eqNullSafe(ids[order]), "left_semi")
    best = best_rows(scored(same)[0], "entity_name", "score", order)
    return best.join(ranked.drop(order), "entity_name").drop("norm", "rank")


def enrich(inputs: DataFrame, registry: DataFrame, state: str, prefixed: bool = True, fetched_at: Column | str = "") -> DataFrame:
    """inputs (ord, entity_name, optionally entity_type) with the universal columns; persons in Texas are not looked up.

    Everything is derived once a name, shared signals count the name's inputs, and the finished columns are joined to the inputs.
    ``fetched_at`` marks when: a fixed text, or utc_now() for the query's own time.
    """
    inputs = inputs.select("ord", "entity_name")
    names = inputs.groupBy("entity_name").agg(F.count("*").alias("inputs_"))
    best = BUILD[state](best_matches(inputs, registry, state))
    rows = shared_signals(cut(complete(names, best)), "ca" if state == "ca" else "flag", "inputs_").drop("inputs_")
    rows = rows.withColumn("alternates", F.coalesce(F.to_json("alternates"), F.lit(""))).withColumn("query_attempts", _c("query_used")).withColumn("fetched_at", F.lit(""))
    at = "fetched_at"
    if prefixed:
        out, at = universal(rows, state), PREFIX[state] + at
        rows = out.select("entity_name", *(n for n in out.columns if n.startswith(PREFIX[state])))
    done = measured(rows.withColumnRenamed("entity_name", "asked_"))
    out = inputs.join(done, inputs["entity_name"].eqNullSafe(done["asked_"]), "left").drop("asked_")
    return out.withColumn(at, (F.lit(fetched_at) if isinstance(fetched_at, str) else fetched_at).cast("string"))


def utc_now() -> Column:
    """The query's time in UTC, to the second, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def without_persons(inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inputs to look up, and persons, which only get a stub row."""
    person = F.lower(blank(_c("entity_type"))) == "person"
    return inputs.filter(~person), inputs.filter(person)


def rescore(rows: DataFrame, state: str) -> DataFrame:
    """Recompute what is derived, without matching again."""
    derived = BUILD[state](rows) if state in ("ca", "tx") else rows
    return shared_signals(derived, "ca" if state == "ca" else "flag")


def backfill_drawer(rows: DataFrame, parsed: DataFrame, columns: list[str]) -> DataFrame:
    """Blank columns of rows take the values parsed again from captured text."""
    p = parsed.select("entity_number", *(_c(c).alias(c + "_p") for c in columns))
    out = rows.join(p, "entity_number", "left")
    return out.withColumns({c: F.coalesce(F.nullif(F.trim(blank(_c(c))), F.lit("")), blank(_c(c + "_p"))) for c in columns}).drop(*(c + "_p" for c in columns))
