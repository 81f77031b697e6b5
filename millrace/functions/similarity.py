"""Similarity of names and addresses, and registry scores.

Set similarities and scores are Column expressions. The edit-based ratios have no
built-in form and are Arrow-batched pandas functions over the integers of a bit-parallel
longest common subsequence.
"""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import OUT_OF_STATE, blank, let, normalize_address, normalize_for_similarity, strip_status, tokens


def jaccard(a: Column, b: Column) -> Column:
    """Shared tokens over all tokens; 0 if either has none."""
    both = F.struct(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b"))
    share = lambda s: F.when((F.size(s["a"]) > 0) & (F.size(s["b"]) > 0), F.size(F.array_intersect(s["a"], s["b"])) / F.size(F.array_union(s["a"], s["b"]))).otherwise(F.lit(0.0))
    return let(both, share)


def name_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of normalised names."""
    return jaccard(tokens(normalize_for_similarity(a)), tokens(normalize_for_similarity(b)))


def addresses_match(a: Column, b: Column, threshold: float = 0.6) -> Column:
    """Jaccard similarity of normalised addresses is at least the threshold."""
    return jaccard(tokens(normalize_address(a)), tokens(normalize_address(b))) >= threshold


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of one string's positions at once."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * LCS / lengths; 100 for two empty strings."""
    total = len(a) + len(b)
    return 200.0 * lcs(a, b) / total if total else 100.0


def _words(s: str | None) -> list[str]:
    """Lower-case words of letters and digits."""
    return re.sub(r"[^\w]|_", " ", (s or "").lower()).split()


def token_sort(a: str | None, b: str | None) -> int:
    """Rounded ratio of the sorted words; 0 if either has none."""
    x, y = " ".join(sorted(_words(a))), " ".join(sorted(_words(b)))
    return round(ratio(x, y)) if x and y else 0


def token_set(a: str | None, b: str | None) -> int:
    """Best rounded ratio among shared words and either side's shared-plus-own words; 100 if one set holds the other."""
    x, y = set(_words(a)), set(_words(b))
    if not x or not y:
        return 0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 100
    s = " ".join(both)
    left, right = " ".join([*both, *only_x]), " ".join([*both, *only_y])
    best = ratio(left, right)
    if s:
        best = max(best, ratio(s, left), ratio(s, right))
    return round(best)


def contained(a: str | None, b: str | None, inside: float = 1.0) -> float:
    """1 if equal, ``inside`` if one holds the other, else the matching-blocks ratio; 0 without candidate."""
    x, y = (a or "").lower().strip(), (b or "").lower().strip()
    if not y:
        return 0.0
    if x == y:
        return 1.0
    if x in y or y in x:
        return inside
    return difflib.SequenceMatcher(None, x, y).ratio()


@F.pandas_udf(T.IntegerType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """token_sort by row."""
    return pd.Series([token_sort(x, y) for x, y in zip(a, b)], dtype="int32")


@F.pandas_udf(T.IntegerType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """token_set by row."""
    return pd.Series([token_set(x, y) for x, y in zip(a, b)], dtype="int32")


@F.pandas_udf(T.DoubleType())
def filing_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """contained by row; a string inside the other counts 1."""
    return pd.Series([contained(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def direct_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """contained by row; a string inside the other counts 0.9."""
    return pd.Series([contained(x, y, 0.9) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def py_title(x: pd.Series) -> pd.Series:
    """Capitals after every character that is no letter, the rest lower-case."""
    return x.str.title()


def register(spark) -> None:
    """Install the functions for SQL."""
    for f in (token_sort_ratio, token_set_ratio, filing_ratio, direct_ratio, py_title):
        spark.udf.register(f.__name__, f)


def _recency(day: Column) -> Column:
    return F.coalesce(F.datediff(day, F.lit("2000-01-01").cast("date")) * 0.001, F.lit(0.0))


def _outside(is_out: Column, name: Column, state: str) -> Column:
    """Minus 30 for an out-of-state record, unless the input's name hints at one."""
    return F.when(is_out & ~blank(name).rlike(OUT_OF_STATE[state]), F.lit(-30.0)).otherwise(F.lit(0.0))


def _similarity(name: Column, found: Column, known: Column | None) -> Column:
    """The similarity of the names, unless the caller has it."""
    return name_similarity(name, found) if known is None else known


def score_ca(name: Column, found: Column, status: Column, entity_type: Column, jurisdiction: Column, formed: Column, similarity: Column | None = None) -> Column:
    """California: status, similarity, out of state, recency."""
    s = F.lower(blank(status))
    gone = F.lit(False)
    for word in ("terminated", "dissolved", "cancelled", "canceled", "merged", "surrendered"):
        gone = gone | s.contains(word)
    base = F.when(s.contains("active"), 100.0).when(s.contains("suspended"), 20.0).when(s.contains("forfeited"), -50.0).when(gone, -100.0).otherwise(0.0)
    j = F.lower(blank(jurisdiction))
    out = F.lower(blank(entity_type)).contains("out of state") | ((j != "") & ~j.contains("california"))
    return base + _similarity(name, found, similarity) * 100 + _outside(out, name, "ca") + _recency(F.try_to_date(formed, "MM/dd/yyyy"))


def score_fl(name: Column, found: Column, status: Column, filing_type: Column, similarity: Column | None = None) -> Column:
    """Florida: status, similarity, foreign filing. Its dates are month first, so no recency applies."""
    return F.when(status == "Active", 100.0).otherwise(-50.0) + _similarity(name, found, similarity) * 100 + _outside(blank(filing_type).startswith("FOR"), name, "fl")


def score_ny(name: Column, found: Column, jurisdiction: Column, filed: Column, similarity: Column | None = None) -> Column:
    """New York: all records are active; similarity, jurisdiction, recency."""
    j = F.lower(blank(jurisdiction))
    return 100.0 + _similarity(name, found, similarity) * 100 + _outside((j != "") & ~j.contains("new york"), name, "ny") + _recency(F.try_to_date(F.substring(filed, 1, 10), "yyyy-MM-dd"))


def score_co(name: Column, found: Column, status: Column, entity_type: Column, formed: Column, similarity: Column | None = None) -> Column:
    """Colorado: ordered status tests, similarity to the name without status, foreign type, recency."""
    s = F.lower(blank(status))
    ended = s.contains("dissolved") | s.contains("withdrawn") | s.contains("expired") | s.contains("merged")
    base = F.when(s.contains("good standing"), 100.0).when(s.contains("compliant") | s.contains("active"), 80.0).when(s.contains("delinquent"), 0.0).when(s.contains("administratively"), -75.0).when(ended, -50.0).otherwise(50.0)
    return base + _similarity(name, strip_status(found), similarity) * 100 + _outside(F.upper(blank(entity_type)).startswith("F"), name, "co") + _recency(F.try_to_date(F.substring(formed, 1, 10), "yyyy-MM-dd"))


def score_tx(name: Column, found: Column, similarity: Column | None = None) -> Column:
    """Texas: every candidate is real; similarity decides."""
    return 50.0 + _similarity(name, found, similarity) * 100
