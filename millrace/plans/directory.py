"""The directory pipeline: raw records to operators, tiers and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import HEADER_WORDS_QSR, HEADER_WORDS_SENIOR, blank, classify, format_phone, normalize_name, normalize_name_senior, title_case, valid_record_name
from ..operators.resolution import resolve
from ..operators.rollup import icp_rows, operators


def _first_locations(records: DataFrame) -> DataFrame:
    """First record of each (document, lower-case name, lower-case address)."""
    w = Window.partitionBy("brand", F.lower(F.trim(blank(F.col("name")))), F.lower(F.trim(blank(F.col("address"))))).orderBy("ord")
    return records.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_")


def records(extracted: DataFrame) -> DataFrame:
    """ord, brand, name, address, city, state, zip, phone to valid, distinct raw location records."""
    good = _first_locations(extracted.filter(valid_record_name(F.col("name"), HEADER_WORDS_QSR)))
    t = lambda c: blank(F.col(c))
    return good.select("ord", "brand", normalize_name(F.trim(t("name"))).alias("franchisee_name"), F.trim(t("address")).alias("raw_address"), title_case(t("city")).alias("city"), F.upper(t("state")).alias("state"), t("zip").alias("zip"), t("phone").alias("restaurant_phone"))


def care_records(extracted: DataFrame) -> DataFrame:
    """The senior-care variant, with the state's full name and a formatted phone."""
    good = _first_locations(extracted.filter(valid_record_name(F.col("name"), HEADER_WORDS_SENIOR)))
    t = lambda c: blank(F.col(c))
    return good.select("ord", "brand", normalize_name_senior(t("name")).alias("franchisee_name"), t("state_full").alias("state_full"), F.trim(t("address")).alias("raw_address"), title_case(t("city")).alias("city"), F.upper(t("state")).alias("state"), t("zip").alias("zip"), format_phone(t("phone")).alias("restaurant_phone"))


def registry(raw: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Raw records to one row per operator."""
    return operators(resolve(raw, decisions))


def classified(rows: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """rows with entity_type, classification_method and search_target: rules, else a table of answers by name, else company."""
    out = rows.withColumn("rule_", classify(F.col("franchisee_name")))
    if answers is not None:
        known = answers.groupBy("franchisee_name").agg(F.first("entity_type").alias("a_type"), F.first("search_target").alias("a_target"))
        out = out.join(known, "franchisee_name", "left")
    else:
        out = out.withColumn("a_type", F.lit(None).cast("string")).withColumn("a_target", F.lit(None).cast("string"))
    pick = lambda rule, answer, default: F.coalesce(rule, answer, default)
    method: Column = F.when(F.col("rule_").isNotNull(), "regex").when(F.col("a_type").isNotNull(), "cache").otherwise("default")
    return out.withColumns({"entity_type": pick(F.col("rule_.entity_type"), F.col("a_type"), F.lit("company")), "classification_method": method, "search_target": pick(F.col("rule_.search_target"), F.col("a_target"), F.col("franchisee_name"))}).drop("rule_", "a_type", "a_target")


def outreach(raw: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Raw records to classified rows of tier A and B."""
    return classified(icp_rows(registry(raw, decisions)))
