"""Parsers of captured registry pages, as Column expressions on the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.names import blank

# Labels and stop words of the captured pages.
CA_LABELS = ("Principal Address", "Mailing Address", "Statement of Info Due Date", "Inactive Date", "Agent", "Standing - SOS", "Standing - FTB", "Standing - Agent", "Standing - VCFCF")
CA_STOP = r"(?i)^(CA Registered|Authorized|Address Type|History|Documents|Statements?|Filed Documents|View History|View Details)"
TX_STOP = r"(?i)^(Taxpayer Number|Mailing Address|Right to Transact|State of Formation|SOS Registration Status|Effective SOS Registration|Texas SOS File Number|Registered Agent Name|Registered Office|Public Information Report|Public Information Reports|Officer|Director|Required Applications)"


def _lines(text: Column) -> Column:
    return F.transform(F.split(blank(text), "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))


def _take(text: Column, stop: str, most: int) -> Column:
    """Lines from the first non-blank one, up to a blank line, a stop word or ``most``."""
    start = F.struct(F.lit(False).alias("done"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        ends = acc["done"] | ((line == "") & (F.size(acc["out"]) > 0)) | line.rlike(stop) | (F.size(acc["out"]) >= most)
        return F.struct(ends.alias("done"), F.when(~ends & (line != ""), F.concat(acc["out"], F.array(line))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(_lines(text), start, step, lambda acc: acc["out"])


def _section(text: Column, label: str) -> Column:
    """Text behind a label (at a line start, with a tab) up to the next label; null without it."""
    labels = "|".join(x.replace("-", r"\-") for x in CA_LABELS)
    found = F.regexp_extract(blank(text), rf"(?s)(?:\n|^){label}\s*\t(.*?)(?=\n(?:{labels})\s*\t|$)", 1)
    return F.when(blank(text).rlike(rf"(?:\n|^){label}\s*\t"), found)


def ca_drawer(text: Column) -> dict[str, Column]:
    """Columns of a detail drawer; blank where a label is missing."""
    joined = lambda label: F.coalesce(F.array_join(_take(_section(text, label), CA_STOP, 3), ", "), F.lit(""))
    one = lambda label: blank(F.get(_take(_section(text, label), CA_STOP, 1), F.lit(0)))
    agent = F.filter(_lines(_section(text, "Agent")), lambda s: s != "")
    kind = blank(F.get(agent, F.lit(0)))
    person = F.lower(kind).startswith("individual")
    address = F.when(person & (F.size(agent) >= 3), F.array_join(_take(F.array_join(F.slice(agent, 3, 1000), "\n"), CA_STOP, 3), ", ")).otherwise("")
    return {
        "principal_address": joined("Principal Address"), "mailing_address": joined("Mailing Address"),
        "statement_due_date": one("Statement of Info Due Date"), "inactive_date": one("Inactive Date"),
        "standing_sos": one("Standing - SOS"), "standing_ftb": one("Standing - FTB"), "standing_agent": one("Standing - Agent"), "standing_vcfcf": one("Standing - VCFCF"),
        "agent_type": kind, "agent_is_individual": F.when(kind == "", "").when(person, "True").otherwise("False"), "agent_address": address,
    }


def ca_row(text: Column) -> dict[str, Column]:
    """Columns of a result row: a line ``NAME (digits)`` and a line of five tab-separated values."""
    lines = F.filter(_lines(text), lambda s: s != "")
    name = blank(F.get(F.filter(lines, lambda s: s.rlike(r"^.+?\s*\(\d{5,}\)\s*$")), F.lit(0)))
    cells = lambda s: F.filter(F.transform(F.split(s, "\t"), lambda x: F.trim(x)), lambda x: x != "")
    row = F.get(F.filter(F.transform(F.filter(lines, lambda s: s.contains("\t")), cells), lambda r: F.size(r) >= 5), F.lit(0))
    out = {"first_result_name": name, "entity_number": F.regexp_extract(name, r"\((\d{5,})\)\s*$", 1)}
    return out | {k: blank(F.get(row, F.lit(i))) for i, k in enumerate(("formation_date", "status", "entity_type", "jurisdiction", "agent_name"))}


def tx_detail(text: Column) -> dict[str, Column]:
    """Columns of a detail page: labels with the value on the next lines."""
    t = blank(text)
    one = lambda label: F.trim(F.regexp_extract(t, rf"{label}\s*\n+([^\n]+)", 1))
    many = lambda label: F.array_join(_take(F.regexp_extract(t, rf"(?s){label}\s*\n+(.*)$", 1), TX_STOP, 4), ", ")
    return {
        "taxpayer_number": one("Taxpayer Number:"), "mailing_address": many("Mailing Address:"), "right_to_transact": one("Right to Transact Business in Texas:"),
        "jurisdiction": one("State of Formation:"), "sos_registration_status": F.trim(F.regexp_extract(t, r"SOS Registration Status[^\n]*\n(?:\([^)]*\)[^\n]*\n)?\s*([^\n]+)", 1)),
        "formation_date": one("Effective SOS Registration Date:"), "sos_file_number": one("Texas SOS File Number:"), "agent_name": one("Registered Agent Name:"), "agent_address": many("Registered Office Street Address:"),
    }
