"""JSON out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import blank

ENTITY_TYPES = ("person", "company", "company_with_owner")


def safe_json(c: Column, schema: str) -> Column:
    """Fences stripped and parsed; else the widest {...} or [...] parsed; null if neither holds."""
    bare = F.trim(F.regexp_replace(F.trim(F.regexp_replace(blank(c), r"```(?:json)?", "")), "`+$", ""))
    wide = F.regexp_extract(bare, r"(?s)(\{.*\}|\[.*\])", 1)
    read = lambda s: F.when(F.try_parse_json(s).isNotNull(), F.from_json(s, schema))
    return F.coalesce(read(bare), read(F.when(wide != "", wide)))


def entity_answer(answer: Column, name: Column) -> Column:
    """struct(entity_type, search_target) from the first flat {...} of an answer; company and the name by default."""
    body = F.regexp_extract(blank(answer), r"(?s)\{.*?\}", 0)
    obj = F.from_json(body, "entity_type string, search_target string")
    kind = F.lower(F.trim(blank(obj["entity_type"])))
    target = F.trim(blank(obj["search_target"]))
    return F.struct(F.when(kind.isin(*ENTITY_TYPES), kind).otherwise("company").alias("entity_type"), F.when(target != "", target).otherwise(name).alias("search_target"))


def string_array(c: Column) -> Column:
    """The first [...] of a text as array<string>; null if malformed."""
    return F.from_json(F.regexp_extract(blank(c), r"(?s)\[.*\]", 0), "array<string>")


def json_lines(c: Column, schema: str) -> Column:
    """Objects of the lines that parse."""
    each = F.transform(F.split(blank(c), "\n"), lambda s: F.when(F.try_parse_json(s).isNotNull(), F.from_json(s, schema)))
    return F.filter(each, lambda o: o.isNotNull())
