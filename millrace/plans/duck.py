"""DuckDB snippets that state, independently, what the Column functions compute."""

from __future__ import annotations

from ..functions.names import COMPANY_KEYWORDS, COMPANY_SUFFIXES, CORPORATE_SIGNALS, PERSON, SKIP_WORDS, STREET_WORDS, TRAILING_SUFFIX


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    """Every match replaced."""
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, '{flags}')"


def squeeze(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


def similar(x: str) -> str:
    """Normal form for similarity."""
    s = f"replace({sub(f'lower({x})', r'\([^)]*\)', ' ')}, '&', ' and ')"
    s = sub(s, r"\b(llc|l\.l\.c\.?|inc|incorporated|limited|ltd|llp|l\.l\.p\.?|l\.p\.?|corp|corporation|company|co)\b\.?", " ")
    return squeeze(sub(s, r"[^\w\s]", " "))


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def address(x: str) -> str:
    return squeeze(sub(sub(f"lower({x})", r"[^\w\s]", " "), rf"\b({'|'.join(STREET_WORDS)})\b\.?", ""))


def jaccard(a: str, b: str) -> str:
    """Shared over all distinct words of two normal forms."""
    x, y = f"list_distinct({words(a)})", f"list_distinct({words(b)})"
    return f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) END"


def parens(x: str) -> str:
    return f"trim(regexp_extract({x}, '\\(([^)]+)\\)', 1))"


def corporate(x: str) -> str:
    listed = "[" + ",".join(q(w) for w in CORPORATE_SIGNALS) + "]"
    return f"len(list_intersect(list_transform({words(squeeze(x))}, lambda w: upper(regexp_replace(w, '[.,]+$', ''))), {listed})) > 0"


def owner(x: str) -> str:
    inner = parens(x)
    person = lambda y: f"(len({words(squeeze(y))}) >= 2 AND NOT ({corporate(y)}))"
    return f"CASE WHEN {person(inner)} THEN lower({inner}) WHEN {person(x)} THEN lower(trim({x})) END"


def company(x: str) -> str:
    any_ = "|".join(rf"\b{p}\b" for p in (*COMPANY_SUFFIXES, *COMPANY_KEYWORDS))
    return f"regexp_matches({x}, {q('(?i)' + any_)})"


def person(x: str) -> str:
    return f"regexp_matches({x}, {q(PERSON)})"


def title(x: str) -> str:
    """Capitals after every non-letter."""
    letters = f"string_split(lower({x}), '')"
    return f"array_to_string(list_transform({letters}, lambda c, i: CASE WHEN i = 1 OR NOT regexp_matches({letters}[i-1], '\\p{{L}}') THEN upper(c) ELSE c END), '')"


def variants(x: str) -> str:
    """The four candidate simplifications, in order, cleaned."""
    bare = f"trim({sub(x, r'\s*\([^)]*\)\s*$', '', '')})"
    base = sub(f"trim({sub(bare, TRAILING_SUFFIX, '', '')})", ",+$", "", "")
    keep = f"list_filter({words(similar(x))}, lambda w: w NOT IN ({','.join(q(w) for w in SKIP_WORDS)}))"
    firsts = [f"CASE WHEN len({keep}) >= {n} THEN array_to_string({keep}[1:{n}], ' ') ELSE '' END" for n in (3, 2)]
    cleaned = f"list_transform([{bare}, {base}, {', '.join(firsts)}], lambda v: regexp_replace(trim(v), '[,.]+$', ''))"
    fit = f"list_filter({cleaned}, lambda v: length(v) >= 4 AND lower(v) <> lower({x}))"
    return f"list_filter({fit}, lambda v, i: list_position(list_transform({fit}, lambda u: lower(u)), lower(v)) = i)"


def joined(*parts: str) -> str:
    """Non-blank parts, comma-joined."""
    return f"array_to_string(list_filter([{', '.join(f'trim({p})' for p in parts)}], lambda p: p <> ''), ', ')"


def city_line(line1: str, city: str, state: str, zip_: str) -> str:
    csz = joined(city, state)
    return joined(line1, f"CASE WHEN {csz} <> '' AND {zip_} <> '' THEN {csz} || ' ' || {zip_} ELSE {csz} END")


def lcs(pairs: str) -> str:
    """CTEs that end in ``lcs_of(x, y, n)``: longest common subsequences of the distinct ``x, y`` of a query, by bit rows."""
    return f"""lcs_in AS (SELECT DISTINCT x, y FROM ({pairs})),
lcs_bits AS (SELECT s, ch, sum(1::HUGEINT << i::INT)::HUGEINT AS m FROM (SELECT s, unnest(string_split(s, '')) AS ch, unnest(range(0, length(s))) AS i FROM (SELECT DISTINCT x AS s FROM lcs_in WHERE x <> '')) GROUP BY s, ch),
lcs_maps AS (SELECT s, map(list(ch), list(m)) AS mp FROM lcs_bits GROUP BY s),
lcs_rows AS (SELECT x, y, (1::HUGEINT << length(x)::INT) - 1 AS full_, list_transform(string_split(y, ''), lambda ch: coalesce(mp[ch], 0)::HUGEINT) AS hits FROM lcs_in JOIN lcs_maps ON s = x WHERE y <> ''),
lcs_of AS (SELECT x, y, length(x) - bit_count(list_reduce(hits, lambda r, h: (((r + (r & h)) | (r - (r & h))) & full_)::HUGEINT, full_::HUGEINT)) AS n FROM lcs_rows)"""


def plain_words(x: str) -> str:
    """Lower-case words of letters and digits."""
    return words(sub(f"lower({x})", r"[^\w]|_", " "))


def blocked_scores(reps: str) -> str:
    """CTEs from ``reps(brand, franchisee_name, state, ord)`` to ``scored(scope, a_ord, b_ord, a_name, b_name, score)``."""
    both = "list_sort(list_filter(a_set, lambda w: list_contains(b_set, w)))"
    own = lambda p, o: f"list_sort(list_filter({p}_set, lambda w: NOT list_contains({o}_set, w)))"
    join = lambda x: f"array_to_string({x}, ' ')"
    return f"""{reps}, st AS (SELECT *, upper(trim(state)) AS st FROM reps),
blocked AS (SELECT 'same_brand' AS scope, a.ord AS a_ord, b.ord AS b_ord, a.franchisee_name AS a_name, b.franchisee_name AS b_name FROM st a JOIN st b ON a.brand = b.brand AND a.ord < b.ord AND (a.st = b.st OR a.st = '' OR b.st = '')
  UNION ALL SELECT 'cross_brand', a.ord, b.ord, a.franchisee_name, b.franchisee_name FROM st a JOIN st b ON a.st = b.st AND a.st <> '' AND a.brand <> b.brand AND a.ord < b.ord),
named AS (SELECT DISTINCT scope, a_name, b_name, list_sort({plain_words('a_name')}) AS a_all, list_sort({plain_words('b_name')}) AS b_all, list_distinct({plain_words('a_name')}) AS a_set, list_distinct({plain_words('b_name')}) AS b_set FROM blocked),
parted AS (SELECT *, {both} AS both_, {own('a', 'b')} AS a_own, {own('b', 'a')} AS b_own FROM named),
texts AS (SELECT *, CASE WHEN scope = 'same_brand' THEN {join('list_concat(both_, a_own)')} ELSE {join('a_all')} END AS x, CASE WHEN scope = 'same_brand' THEN {join('list_concat(both_, b_own)')} ELSE {join('b_all')} END AS y, {join('both_')} AS s FROM parted),
{lcs('SELECT x, y FROM texts')},
rated AS (SELECT t.scope, t.a_name, t.b_name, round_even(CASE WHEN len(a_set) = 0 OR len(b_set) = 0 THEN 0.0 WHEN t.scope = 'same_brand' AND len(both_) > 0 AND (len(a_own) = 0 OR len(b_own) = 0) THEN 100.0
  WHEN t.scope = 'same_brand' AND s <> '' THEN greatest(200.0::DOUBLE * n / (length(t.x) + length(t.y)), 200.0::DOUBLE * length(s) / (length(s) + length(t.x)), 200.0::DOUBLE * length(s) / (length(s) + length(t.y)))
  ELSE 200.0::DOUBLE * n / (length(t.x) + length(t.y)) END, 0)::INT AS score FROM texts t LEFT JOIN lcs_of USING (x, y)),
scored AS (SELECT b.*, r.score FROM blocked b JOIN rated r USING (scope, a_name, b_name) WHERE r.score >= CASE WHEN scope = 'same_brand' THEN 82 ELSE 60 END)"""
