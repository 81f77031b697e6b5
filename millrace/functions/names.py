"""Names, addresses and other strings as Column expressions.

All stay inside the JVM. Word classes use ``(?U)`` so that accented letters count as
letters. Missing values are empty strings, never null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes, word lists and patterns that results depend on.
LEGAL_WORDS = r"\b(llc|l\.l\.c\.?|inc|incorporated|limited|ltd|llp|l\.l\.p\.?|l\.p\.?|corp|corporation|company|co)\b\.?"
TRAILING_SUFFIX = r"(?i)\s*[,\.]?\s*\b(LLC|L\.L\.C\.?|Llc|Inc\.?|Incorporated|Limited|Ltd\.?|Llp|L\.L\.P\.?|L\.P\.?|Corp\.?|Corporation|Company|Co\.?)\s*$"
SKIP_WORDS = ("holdings", "group", "management", "ventures", "enterprises", "investments", "concepts", "operating", "operations", "the", "a", "an")
STREET_WORDS = ("street", "avenue", "blvd", "boulevard", "drive", "lane", "road", "suite", "apt", "ste", "floor", "fl", "unit")
CORPORATE_SIGNALS = ("LLC", "INC", "CORP", "CO", "LTD", "COMPANY", "GROUP", "HOLDINGS", "ENTERPRISES", "RESTAURANTS", "FOODS", "VENTURES", "PARTNERS", "PARTNERSHIP", "ASSOCIATES", "MANAGEMENT", "PROPERTIES")
COMPANY_SUFFIXES = (r"L\.?L\.?C\.?", r"L\.?L\.?P\.?", r"L\.?P\.?", r"P\.?L\.?L\.?C\.?", r"Inc\.?", "Incorporated", r"Corp\.?", "Corporation", r"Co\.?", "Company", r"Ltd\.?", "Limited", "GmbH", r"P\.?A\.?", r"N\.?A\.?")
COMPANY_KEYWORDS = ("Holdings?", "Group", "Enterprises?", "Ventures?", "Investments?", "Partners?", "Restaurants?", "Foods?", "Hospitality", "Management", "Stores?", "Brands?", "Properties", "Concepts?", "Systems?", "Services?", "Dining", "Franchise[es]?", "Operating", "Division", "Associates?", "Industries", "Corp", "Trust")
PERSON = r"^[A-Z][a-zA-Z'\-]+(?:\s+[A-Z]\.?)*(?:\s+[A-Z][a-zA-Z'\-]+){1,2}(?:\s+(?:Jr\.?|Sr\.?|II|III|IV))?$"
HEADER_WORDS_QSR = ("NAME", "FRANCHISEE", "EXHIBIT", "SCHEDULE")
HEADER_WORDS_SENIOR = ("NAME", "OWNERS", "EXHIBIT", "LIST OF FRANCHISEES")
QUOTA_MARKERS = ("you've hit your limit", "you have hit your limit", "rate_limit_exceeded", "usage limit", "credit balance is too low", "credit balance", "5-hour limit", "weekly limit", "quota exceeded", "quota_exceeded", "resets ", "out of extra usage", "limit reached", "out_of_credits", "cachedextrausagedisabledreason", "configuration error in", "unexpected end of json input")
ZIP = r"\b\d{5}(?:-\d{4})?\b"
PHONE = r"\(?\b\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b"
STATUS_SUFFIX = r"(?i),\s*(Delinquent|Dissolved|Voluntarily Dissolved|Administratively Dissolved|Withdrawn|Merged|Expired)(\s+[A-Za-z]+\s+\d+,?\s+\d{4})?\s*$"
ATTORNEY = r"(?i)\b(esq|attorney|law)\b"
CORPORATE_AGENT = {
    "ny": r"(?i)\b(llc|inc|corp|service|registered|agent|company|co\.?)\b",
    "tx": r"(?i)\b(llc|inc|corp|service|registered|agent|company|co\.?|csc|corporation)\b",
}
_REGIONS = r"nevada|arizona|oregon|washington|illinois|midwest|northwest|southeast|northeast|hawaii|atlantic|rockies"
OUT_OF_STATE = {
    "ca": rf"(?i)\b(colorado|dakot|rocky\s*mountain|new\s*england|texas|florida|{_REGIONS}|northern|southern)\b",
    "fl": rf"(?i)\b(colorado|dakot|rocky\s*mountain|new\s*england|texas|california|{_REGIONS}|northern|southern)\b",
    "co": rf"(?i)\b(dakot|rocky\s*mountain|new\s*england|texas|california|florida|{_REGIONS})\b",
    "ny": rf"(?i)\b(colorado|dakot|rocky\s*mountain|new\s*england|texas|california|florida|{_REGIONS}|northern|southern)\b",
    "tx": rf"(?i)\b(colorado|dakot|rocky\s*mountain|new\s*england|california|florida|{_REGIONS}|northern|southern)\b",
}


def blank(c: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(c, F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; trimmed."""
    return F.trim(F.regexp_replace(blank(c), r"(?U)\s+", " "))


def title_case(c: Column) -> Column:
    """Capitals after every non-letter, small letters otherwise (``Mcdonald'S``).

    A space is put after each non-letter run's end, initcap works on spaces, and the
    marks go again.
    """
    mark = "⁣"
    spaced = F.regexp_replace(blank(c), r"(?<=[^\p{L}\s])(?=\p{L})", mark + " ")
    return F.regexp_replace(F.initcap(spaced), mark + " ", "")


def normalize_name(c: Column, strict: bool = False) -> Column:
    """Squeezed, one generational suffix stripped, title case. Without ``strict`` the suffix needs no word boundary before it."""
    edge = r"(?:\b|(?<=,))" if strict else ""
    return title_case(F.trim(F.regexp_replace(squeeze(c), rf"(?i),?\s*{edge}(JR\.?|SR\.?|III|II|IV|ESQ\.?)$", "")))


def normalize_name_senior(c: Column) -> Column:
    """Squeezed, final commas and then asterisks stripped."""
    return F.trim(F.regexp_replace(F.regexp_replace(squeeze(c), r",+$", ""), r"\*+$", ""))


def normalize_for_similarity(c: Column) -> Column:
    """Lower case without parentheses, legal words and punctuation; ``&`` is ``and``."""
    s = F.regexp_replace(F.lower(blank(c)), r"\([^)]*\)", " ")
    s = F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" and ")), "(?U)" + LEGAL_WORDS, " ")
    return squeeze(F.regexp_replace(s, r"(?U)[^\w\s]", " "))


def tokens(normal: Column) -> Column:
    """Words of a normalised string; none for the empty string."""
    return F.filter(F.split(normal, " "), lambda t: t != "")


def name_variants(c: Column) -> Column:
    """Ordered simplifications of a name, at least 4 characters, without case-insensitive repeats or the name itself."""
    bare = F.trim(F.regexp_replace(blank(c), r"\s*\([^)]*\)\s*$", ""))
    base = F.regexp_replace(F.trim(F.regexp_replace(bare, TRAILING_SUFFIX, "")), ",+$", "")
    words = F.filter(tokens(normalize_for_similarity(c)), lambda t: ~t.isin(*SKIP_WORDS))
    first = lambda w, n: F.when(F.size(w) >= n, F.array_join(F.slice(w, 1, n), " ")).otherwise(F.lit(""))
    all_ = F.concat(F.array(bare, base), let(words, lambda w: F.array(first(w, 3), first(w, 2))))
    fit = F.filter(F.transform(all_, lambda v: F.regexp_replace(F.trim(v), r"[,.]+$", "")), lambda v: (F.length(v) >= 4) & (F.lower(v) != F.lower(blank(c))))
    once = let(fit, lambda f: F.filter(f, lambda v, i: F.array_position(F.transform(f, lambda u: F.lower(u)), F.lower(v)) == i + 1))
    return F.when(blank(c) == "", F.array().cast("array<string>")).otherwise(once)


def normalize_address(c: Column) -> Column:
    """Lower case without punctuation and street or unit words."""
    s = F.regexp_replace(F.lower(blank(c)), r"(?U)[^\w\s]", " ")
    return squeeze(F.regexp_replace(s, rf"(?U)\b({'|'.join(STREET_WORDS)})\b\.?", ""))


def in_parens(c: Column) -> Column:
    """Trimmed content of the first parentheses, else the empty string."""
    return F.trim(F.regexp_extract(blank(c), r"\(([^)]+)\)", 1))


def first_name(c: Column) -> Column:
    """First word inside the first parentheses, else of the name."""
    word = lambda x: F.element_at(F.split(squeeze(x), " "), 1)
    return F.when(in_parens(c) != "", word(in_parens(c))).otherwise(word(c))


def search_name(c: Column) -> Column:
    """Parenthetical owner if there is one, else the full name."""
    return F.when(F.regexp_like(blank(c), F.lit(r"\([^)]+\)")), in_parens(c)).otherwise(blank(c))


def corporate(c: Column) -> Column:
    """A word of the name is a corporate signal."""
    words = F.transform(tokens(squeeze(c)), lambda w: F.upper(F.regexp_replace(w, r"[.,]+$", "")))
    return F.arrays_overlap(words, F.array(*map(F.lit, CORPORATE_SIGNALS)))


def owner_key(c: Column) -> Column:
    """Lower-case person behind a name: the parenthetical, else the name, if of two words or more and not corporate; else null."""
    person = lambda x: (F.size(tokens(squeeze(x))) >= 2) & ~corporate(x)
    inner = in_parens(c)
    return F.when(let(inner, person), F.lower(inner)).when(person(c), F.lower(F.trim(blank(c))))


def _any_word(patterns: tuple[str, ...]) -> str:
    return "(?i)" + "|".join(rf"\b{p}\b" for p in patterns)


def is_company(c: Column) -> Column:
    """A legal suffix or a business keyword."""
    return c.rlike(_any_word(COMPANY_SUFFIXES)) | c.rlike(_any_word(COMPANY_KEYWORDS))


def classify(c: Column) -> Column:
    """struct(entity_type, search_target), or null where rules do not decide."""
    n = F.trim(blank(c))
    owner = in_parens(n)
    outer = F.regexp_replace(F.regexp_replace(n, r"\([^)]+\)", ""), r"^[ ,]+|[ ,]+$", "")
    pair = lambda kind, target: F.struct(F.lit(kind).alias("entity_type"), target.alias("search_target"))
    none = F.lit(None).cast("struct<entity_type:string,search_target:string>")
    company_out = F.when(is_company(outer), pair("company", outer))
    paren = (
        F.when(owner.rlike(r"(?i)^(?:dba|d/?b/?a)\b"), company_out.otherwise(none))
        .when(owner.rlike(r"^\d+$"), company_out.when(outer.rlike(PERSON), pair("person", outer)).otherwise(none))
        .otherwise(pair("company_with_owner", owner))
    )
    return (
        F.when(n == "", pair("company", blank(c)))
        .when(n.rlike(r"\([^)]+\)"), paren)
        .when(is_company(n), pair("company", n))
        .when(n.rlike(r"[,/&@#$%]|\d"), none)
        .when(n.rlike(PERSON), pair("person", n))
        .otherwise(none)
    )


def format_phone(c: Column) -> Column:
    """(xxx) xxx-xxxx for ten digits, or eleven with a leading one; else trimmed."""
    d = F.regexp_replace(blank(c), r"\D", "")
    ten = F.when(F.length(d) == 10, d).when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10))
    return F.coalesce(F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)), F.trim(blank(c)))


def safe_stem(c: Column, default: str = "brand") -> Column:
    """Non-word runs become one underscore; ends stripped; a default for nothing."""
    s = F.regexp_replace(F.regexp_replace(blank(c), r"(?U)[^\w]+", "_"), r"^_+|_+$", "")
    return F.when(s == "", F.lit(default)).otherwise(s)


def header_name(h: str) -> str:
    """A CSV header as a lower-case, underscored column name."""
    import re

    return re.sub(r"[^\w]+", "_", (h or "").strip().lower()).strip("_")


def brand_key(c: Column) -> Column:
    """Only a-z and 0-9."""
    return F.regexp_replace(F.lower(blank(c)), "[^a-z0-9]", "")


def strip_status(c: Column) -> Column:
    """An entity name without a trailing status such as ``, Delinquent May 1, 2016``."""
    return F.trim(F.regexp_replace(blank(c), STATUS_SUFFIX, ""))


def join_parts(*parts: Column) -> Column:
    """Non-blank parts, comma-joined."""
    return F.array_join(F.filter(F.transform(F.array(*map(blank, parts)), lambda p: F.trim(p)), lambda p: p != ""), ", ")


def city_line(line1: Column, line2: Column, city: Column, state: Column, zip_: Column) -> Column:
    """``line1, line2, city, ST zip`` of the parts there are; the zip only behind a city or state."""
    line = lambda csz: F.when((csz != "") & (blank(zip_) != ""), F.concat_ws(" ", csz, zip_)).otherwise(csz)
    return join_parts(line1, line2, let(join_parts(city, state), line))


def sample_address(line1: Column, city: Column, state: Column, zip_: Column) -> Column:
    """``line1, city, ST zip``; the zip also behind an address without city."""
    body = join_parts(line1, city, state)
    return F.when(blank(zip_) != "", F.trim(F.concat_ws(" ", body, zip_))).otherwise(body)


def parse_names(c: Column) -> Column:
    """Names split at line breaks and commas, trimmed, first of each case-insensitive name."""
    all_ = F.filter(F.transform(F.split(blank(c), r"[\n,]"), lambda v: F.trim(v)), lambda v: v != "")
    lows = F.transform(all_, F.lower)
    return F.filter(all_, lambda v, i: F.array_position(lows, F.lower(v)) == i + 1)


def page_range(c: Column) -> Column:
    """struct(first, last) of a text like ``12-30``; null if it is not one."""
    p = r"^\s*(\d+)\s*[-–]\s*(\d+)\s*$"
    return F.when(blank(c).rlike(p), F.struct(F.regexp_extract(c, p, 1).cast("int").alias("first"), F.regexp_extract(c, p, 2).cast("int").alias("last")))


def page_score(c: Column) -> Column:
    """Postal codes plus twice the phone numbers of a page."""
    return F.regexp_count(blank(c), F.lit(ZIP)) + 2 * F.regexp_count(blank(c), F.lit(PHONE))


def has_quota_marker(c: Column) -> Column:
    """The text says that a usage quota is exhausted."""
    low = F.lower(blank(c))
    return reduce(lambda a, b: a | b, (low.contains(m) for m in QUOTA_MARKERS))


def valid_record_name(c: Column, words: tuple[str, ...] = HEADER_WORDS_QSR) -> Column:
    """Three characters or more, and none of the header words anywhere in it."""
    n = F.trim(blank(c))
    return (F.length(n) >= 3) & ~reduce(lambda a, b: a | b, (F.upper(n).contains(w) for w in words))


def id_like_name(c: Column) -> Column:
    """The name is only an identifier such as 3849-0001."""
    return blank(c).rlike(r"^\d{3,4}-\d{3,4}$")
