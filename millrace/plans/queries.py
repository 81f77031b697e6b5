"""The engine's queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions import names as N
from ..functions import similarity as S
from ..operators import derive, filings, lookup, ordered, resolution, rollup
from ..session import once
from ..sources import captured, readers, sinks
from . import directory, enrich
from . import duck as D
from .samples import LOC_SQL, REG_SQL, locations, registry_rows

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its DuckDB SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_n = "franchisee_name"
c = F.col


# ---- names and other scalars -------------------------------------------------


@query(f"SELECT ord, {D.title(D.sub(D.squeeze(_n), ',?\\s*(JR\\.?|SR\\.?|III|II|IV|ESQ\\.?)$', '', 'i').join(['trim(', ')']))} AS name, {D.similar(_n)} AS normal, {D.title('city')} AS city FROM {LOC_SQL}")
def st_names(spark, d):
    """ST1, ST3, ST5: normalised names and title case."""
    return locations(spark, d).select("ord", N.normalize_name(c(_n)).alias("name"), N.normalize_for_similarity(c(_n)).alias("normal"), N.title_case(c("city")).alias("city"))


@query(f"SELECT ord, {D.address('raw_address')} AS address, CASE WHEN length(dg) = 10 THEN '(' || dg[1:3] || ') ' || dg[4:6] || '-' || dg[7:10] WHEN length(dg) = 11 AND dg[1] = '1' THEN '(' || dg[2:4] || ') ' || dg[5:7] || '-' || dg[8:11] ELSE trim(restaurant_phone) END AS phone FROM (SELECT *, regexp_replace(restaurant_phone, '\\D', '', 'g') AS dg FROM {LOC_SQL})")
def st_address_phone(spark, d):
    """ST6, ST10: normalised addresses and phones."""
    return locations(spark, d).select("ord", N.normalize_address(c("raw_address")).alias("address"), N.format_phone(c("restaurant_phone")).alias("phone"))


@query(f"SELECT ord, array_to_string({D.variants(_n)}, ' / ') AS variants FROM {LOC_SQL}")
def st_name_variants(spark, d):
    """ST4: ordered simplifications of a name."""
    return locations(spark, d).select("ord", F.array_join(N.name_variants(c(_n)), " / ").alias("variants"))


_outer = f"trim({D.sub('n', r'\([^)]+\)')}, ' ,')"
_inner = D.parens("n")


@query(
    f"""WITH t AS (SELECT ord, trim(franchisee_name) AS n FROM {LOC_SQL}),
p AS (SELECT *, {_inner} AS i, {_outer} AS o, regexp_matches(n, '\\([^)]+\\)') AS has FROM t)
SELECT ord, CASE WHEN n = '' THEN 'company' WHEN has AND regexp_matches(i, '(?i)^(dba|d/?b/?a)\\b') THEN CASE WHEN {D.company('o')} THEN 'company' END
 WHEN has AND regexp_matches(i, '^\\d+$') THEN CASE WHEN {D.company('o')} THEN 'company' WHEN {D.person('o')} THEN 'person' END
 WHEN has THEN 'company_with_owner' WHEN {D.company('n')} THEN 'company' WHEN regexp_matches(n, '[,/&@#$%]|\\d') THEN NULL WHEN {D.person('n')} THEN 'person' END AS entity_type,
 CASE WHEN n = '' THEN n WHEN has AND regexp_matches(i, '(?i)^(dba|d/?b/?a)\\b') THEN CASE WHEN {D.company('o')} THEN o END
 WHEN has AND regexp_matches(i, '^\\d+$') THEN CASE WHEN {D.company('o')} OR {D.person('o')} THEN o END
 WHEN has THEN i WHEN {D.company('n')} THEN n WHEN regexp_matches(n, '[,/&@#$%]|\\d') THEN NULL WHEN {D.person('n')} THEN n END AS search_target FROM p"""
)
def st_classify(spark, d):
    """ST9: person, company or company with owner by rules; null where undecided."""
    return locations(spark, d).select("ord", N.classify(c(_n)).alias("k")).select("ord", "k.entity_type", "k.search_target")


@query(
    f"""SELECT ord, {D.owner(_n)} AS owner_key, CASE WHEN {D.parens(_n)} <> '' THEN string_split({D.parens(_n)}, ' ')[1] ELSE string_split({_n}, ' ')[1] END AS first_name,
CASE WHEN {D.parens(_n)} <> '' THEN {D.parens(_n)} ELSE {_n} END AS search_name, regexp_replace(lower({_n}), '[^a-z0-9]', '', 'g') AS brand_key,
trim(regexp_replace({_n}, '[^\\w]+', '_', 'g'), '_') AS stem, regexp_matches({_n}, '^\\d{{3,4}}-\\d{{3,4}}$') AS name_missing FROM {LOC_SQL}"""
)
def st_keys(spark, d):
    """ST7, ST8, ST11, ST12, ER2, PF6: keys and short forms of names."""
    return locations(spark, d).select("ord", N.owner_key(c(_n)).alias("owner_key"), N.first_name(c(_n)).alias("first_name"), N.search_name(c(_n)).alias("search_name"), N.brand_key(c(_n)).alias("brand_key"), N.safe_stem(c(_n)).alias("stem"), N.id_like_name(c(_n)).alias("name_missing"))


@query(
    f"""SELECT rid, trim(regexp_replace(firm, ',\\s*(Delinquent|Dissolved|Voluntarily Dissolved|Administratively Dissolved|Withdrawn|Merged|Expired)(\\s+[A-Za-z]+\\s+\\d+,?\\s+\\d{{4}})?\\s*$', '', 'i')) AS clean,
{D.city_line('street', 'town', 'st', 'post')} AS line, {D.joined('street', 'town', 'st', 'post')} AS plain, regexp_matches(org, '(?i)\\b(esq|attorney|law)\\b') AS attorney,
regexp_matches(org, '(?i)\\b(llc|inc|corp|service|registered|agent|company|co\\.?)\\b') AS corporate FROM {REG_SQL}"""
)
def st_registry_text(spark, d):
    """ST13, ST14, ST19, ST20: status suffixes, address lines, agent tests."""
    r = registry_rows(spark, d)
    return r.select("rid", N.strip_status(c("firm")).alias("clean"), N.city_line(c("street"), F.lit(""), c("town"), c("st"), c("post")).alias("line"), N.join_parts(c("street"), c("town"), c("st"), c("post")).alias("plain"), c("org").rlike(N.ATTORNEY).alias("attorney"), c("org").rlike(N.CORPORATE_AGENT["ny"]).alias("corporate"))


_ZIP, _PHONE = D.q(r"\b\d{5}(?:-\d{4})?\b"), D.q(r"\(?\b\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b")


@query(f"SELECT doc_id, len(regexp_extract_all(text, {_ZIP})) + 2 * len(regexp_extract_all(text, {_PHONE})) AS page_score, md5(text) AS content_hash, contains(lower(text), 'usage limit') OR contains(lower(text), 'resets ') AS quota FROM documents")
def st_page_score(spark, d):
    """ST18, ST21, ST22: address density, quota markers and content hashes of whole texts."""
    docs = tbl(spark, d, "documents")
    return docs.select("doc_id", N.page_score(c("text")).cast("long").alias("page_score"), F.md5(c("text").cast("binary")).alias("content_hash"), N.has_quota_marker(c("text")).alias("quota"))


@query(f"SELECT ord, list_filter(list_transform(string_split_regex(v, '[\\n,]'), lambda s: trim(s)), lambda s: s <> '')::VARCHAR AS parts, CASE WHEN ord % 3 = 0 THEN (ord % 50)::INT END AS first_page, CASE WHEN ord % 3 = 0 THEN (ord % 50 + 7)::INT END AS last_page FROM (SELECT ord, brand || ',' || chr(10) || city || ', ' AS v FROM {LOC_SQL})")
def st_lists(spark, d):
    """ST15, ST16: name lists and page ranges out of text."""
    t = locations(spark, d).select("ord", F.concat("brand", F.lit(",\n"), "city", F.lit(", ")).alias("v"), F.when(c("ord") % 3 == 0, F.concat((c("ord") % 50).cast("string"), F.lit(" – "), (c("ord") % 50 + 7).cast("string"))).otherwise("all").alias("r"))
    return t.select("ord", F.concat(F.lit("["), F.array_join(N.parse_names(c("v")), ", "), F.lit("]")).alias("parts"), N.page_range(c("r")).alias("p")).select("ord", "parts", c("p.first").alias("first_page"), c("p.last").alias("last_page"))


@query(
    f"""SELECT rid, substr(mmddyyyy, 1, 2) || '/' || substr(mmddyyyy, 3, 2) || '/' || substr(mmddyyyy, 5, 4) AS us_from_digits,
CASE WHEN iso LIKE '____-__-__' THEN strftime(iso::DATE, '%m/%d/%Y') ELSE substr(iso, 1, 10) END AS us_from_iso,
CASE WHEN iso LIKE '____-__-__' THEN iso END AS parsed, CASE WHEN iso LIKE '____-__-__' THEN (iso::DATE - DATE '2000-01-01')::INT END AS days FROM {REG_SQL}"""
)
def dt_dates(spark, d):
    """DT1, DT2, DT3: date formats and day differences."""
    r = registry_rows(spark, d)
    day = derive.any_date(c("iso"))
    return r.select("rid", derive.month_first_date(c("mmddyyyy")).alias("us_from_digits"), derive.us_date(c("iso")).alias("us_from_iso"), day.cast("string").alias("parsed"), F.datediff(day, F.lit("2000-01-01").cast("date")).alias("days"))


@query(
    """WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || '{"entity_type": "person", "search_target": "P' || event_id || '"}' || chr(10) || '```' WHEN 1 THEN 'so: {"entity_type": "Robot", "search_target": ""} done' WHEN 2 THEN 'no json' ELSE 'x {"entity_type": "company_with_owner", "search_target": "Q"}' END AS a FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'Robot' WHEN 3 THEN 'company_with_owner' END AS safe_type,
CASE event_id % 4 WHEN 0 THEN 'person' WHEN 3 THEN 'company_with_owner' ELSE 'company' END AS entity_type,
CASE event_id % 4 WHEN 0 THEN 'P' || event_id WHEN 3 THEN 'Q' ELSE 'N' END AS search_target FROM t"""
)
def js_answers(spark, d):
    """JS1, JS2: answers with fences and prose around their JSON."""
    e = tbl(spark, d, "events").select("event_id")
    a = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('```json\n{"entity_type": "person", "search_target": "P', event_id, '"}\n```') WHEN 1 THEN 'so: {"entity_type": "Robot", "search_target": ""} done' WHEN 2 THEN 'no json' ELSE 'x {"entity_type": "company_with_owner", "search_target": "Q"}' END""")
    t = e.withColumn("a", a).select("event_id", J.safe_json(c("a"), "entity_type string, search_target string").alias("s"), J.entity_answer(c("a"), F.lit("N")).alias("e"))
    return t.select("event_id", c("s.entity_type").alias("safe_type"), "e.entity_type", "e.search_target")


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 2 END AS good_lines, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'a|b' || event_id END AS listed,
'[{"name":"' || event_type || '","score":' || (event_id % 7)::VARCHAR || '}]' AS dumped FROM events"""
)
def js_arrays(spark, d):
    """JS3, JS4, JS5: JSON lines, arrays in text, arrays of structs to JSON."""
    e = tbl(spark, d, "events").select("event_id", "event_type")
    lines = F.when(c("event_id") % 3 == 0, F.lit("bad\n{")).otherwise(F.lit('{"n": 1}\nbad\n{"n": 2}'))
    text = F.when(c("event_id") % 5 == 0, F.lit("none")).otherwise(F.concat(F.lit('Here: ["a", "b'), "event_id", F.lit('"] ok')))
    return e.select("event_id", F.size(J.json_lines(lines, "n int")).alias("good_lines"), F.array_join(J.string_array(text), "|").alias("listed"), F.to_json(F.array(F.struct(c("event_type").alias("name"), (c("event_id") % 7).alias("score")))).alias("dumped"))


# ---- filters and projections -------------------------------------------------


@query(
    f"""SELECT brand, {D.title("trim(regexp_replace(" + D.squeeze("name") + ", ',?\\s*(JR\\.?|SR\\.?|III|II|IV|ESQ\\.?)$', '', 'i'))")} AS franchisee_name, trim(address) AS raw_address, {D.title('city')} AS city, upper(state) AS state, ord
FROM (SELECT *, row_number() OVER (PARTITION BY brand, lower(trim(name)), lower(trim(address)) ORDER BY ord) AS rn FROM (SELECT *, franchisee_name AS name, raw_address AS address FROM {LOC_SQL})
WHERE length(trim(franchisee_name)) >= 3 AND NOT regexp_matches(upper(franchisee_name), 'NAME|FRANCHISEE|EXHIBIT|SCHEDULE')) WHERE rn = 1"""
)
def pf_records(spark, d):
    """PF1, PF3, SO3: valid, distinct, normalised location records."""
    raw = locations(spark, d).select("ord", "brand", c(_n).alias("name"), c("raw_address").alias("address"), "city", "state", "zip", c("restaurant_phone").alias("phone"))
    return directory.records(raw).select("brand", _n, "raw_address", "city", "state", "ord")


@query(
    f"""SELECT ord, regexp_replace(regexp_replace({D.squeeze(_n)}, ',+$', ''), '\\*+$', '') AS franchisee_name, 'Full ' || state AS state_full
FROM (SELECT *, row_number() OVER (PARTITION BY brand, lower(trim(franchisee_name)), lower(trim(raw_address)) ORDER BY ord) AS rn FROM {LOC_SQL}
WHERE length(trim(franchisee_name)) >= 3 AND NOT regexp_matches(upper(franchisee_name), 'NAME|OWNERS|EXHIBIT|LIST OF FRANCHISEES')) WHERE rn = 1"""
)
def pf_care_records(spark, d):
    """PF2, PF4, ST2: the senior-care projection."""
    raw = locations(spark, d).select("ord", "brand", c(_n).alias("name"), c("raw_address").alias("address"), "city", "state", "zip", c("restaurant_phone").alias("phone"), F.concat(F.lit("Full "), "state").alias("state_full"))
    return directory.care_records(raw).select("ord", _n, "state_full")


@query(
    f"""SELECT tier, count(*) AS operators, sum(u)::BIGINT AS units FROM (SELECT u, CASE WHEN u BETWEEN 16 AND 200 THEN 'A' WHEN u BETWEEN 5 AND 15 THEN 'B' WHEN u > 200 THEN 'large' WHEN u IS NOT NULL THEN 'small' END AS tier
FROM (SELECT TRY_CAST(CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE (c_custkey % 260)::VARCHAR END AS INT) AS u FROM customer)) GROUP BY tier"""
)
def pf_tiers(spark, d):
    """PF7: size tiers; what is not a number has none."""
    t = tbl(spark, d, "customer").select(F.when(c("c_custkey") % 11 == 0, F.lit("x")).otherwise((c("c_custkey") % 260).cast("string")).alias("u"))
    return t.select(rollup.tier_of(c("u")).alias("tier"), c("u").try_cast("int").alias("u")).groupBy("tier").agg(F.count("*").alias("operators"), F.sum("u").alias("units"))


@query(f"SELECT i.ord, i.entity_name FROM (SELECT ord, franchisee_name AS entity_name FROM {LOC_SQL}) i WHERE trim(entity_name) <> '' AND lower(trim(entity_name)) NOT IN (SELECT lower(trim(franchisee_name)) FROM {LOC_SQL} WHERE ord % 50 = 0) ORDER BY ord LIMIT 200")
def pf_pending(spark, d):
    """PF10, J8, SR1, TK7: inputs not yet done, first 200 by order (the row limit is the feature)."""
    loc = locations(spark, d)
    inputs = loc.select("ord", c(_n).alias("entity_name"))
    done = loc.filter("ord % 50 = 0 or ord % 50 = 1").select(c(_n).alias("entity_name"), F.when(c("ord") % 50 == 0, F.lit("2026-01-01")).otherwise("").alias("fetched_at"))
    return lookup.not_done(inputs, done, 200)


@query(f"""SELECT ord, CASE WHEN upper(state) = 'TX' AND lower(trim(franchisee_name)) LIKE '%foods%' THEN 'Known Co (' || franchisee_name || ')' ELSE franchisee_name END AS franchisee_name FROM {LOC_SQL}""")
def pf_backfill(spark, d):
    """PF11, J9, ER9: one confident answer per (name, state) renames all rows of the group."""
    loc = locations(spark, d)
    key = F.concat_ws("|", F.lower(F.trim(_n)), F.upper(F.trim("state")))
    answers = loc.select(key.alias("key"), F.when(c(_n).rlike("(?i)foods") & key.endswith("|TX"), "HIGH").otherwise("LOW").alias("confidence")).distinct().withColumns({"company": F.lit("Known Co"), "source_url": F.lit("u")})
    return lookup.backfill(loc, answers, key).select("ord", _n)


# ---- entity resolution -------------------------------------------------------


@query(
    f"""SELECT brand, count(*) AS records, count(*) FILTER (k IS NOT NULL AND k = lower({D.parens(_n)})) AS grouped_parens, count(*) FILTER (k IS NOT NULL AND k <> lower({D.parens(_n)})) AS grouped_person, count(*) FILTER (k IS NULL) AS ungrouped
FROM (SELECT *, {D.owner(_n)} AS k FROM {LOC_SQL}) GROUP BY brand"""
)
def er_brand_audit(spark, d):
    """AG4, ER2: how an owner key would group each brand."""
    return resolution.brand_audit(locations(spark, d))


_COMPS = f"""nodes AS (SELECT *, brand || '~' || lower(trim(franchisee_name)) AS nk, {D.owner(_n)} AS ok FROM {LOC_SQL}),
names AS (SELECT DISTINCT nk, brand || '~' || ok AS gk FROM nodes),
reach AS (SELECT DISTINCT a.nk AS a, b.nk AS b FROM names a JOIN names b ON a.gk = b.gk UNION SELECT nk, nk FROM names),
low AS (SELECT nk, min(ord) AS o FROM nodes GROUP BY nk),
comp AS (SELECT r.a AS nk, min(l.o) AS comp FROM reach r JOIN low l ON r.b = l.nk GROUP BY r.a),
resolved AS (SELECT n.*, c.comp FROM nodes n JOIN comp c USING (nk))"""
# A name has one owner key, so one hop over shared keys is the whole closure.


@query(f"WITH {_COMPS} SELECT ord, comp FROM resolved")
def er_components(spark, d):
    """ER1, ER3, ER5: exact and owner edges to connected components."""
    return resolution.resolve(locations(spark, d), auto=False).select("ord", "comp")


_ROLL = """SELECT {key} AS k, arg_max(franchisee_name, length(franchisee_name) * 1000000000 - ord) AS franchisee_name, CASE WHEN count(DISTINCT franchisee_name) > 1 THEN array_to_string(list_sort(list(DISTINCT franchisee_name)), ' / ') ELSE '' END AS name_variants,
count(*)::INT AS total_units, array_to_string(list_sort(list(DISTINCT brand)), ' | ') AS brands_operated, count(DISTINCT brand)::INT AS brand_count, CASE WHEN count(DISTINCT brand) > 1 THEN 'Yes' ELSE 'No' END AS is_multi_brand,
coalesce(array_to_string(list_sort(list(DISTINCT state) FILTER (state <> '')), ' | '), '') AS all_states, count(DISTINCT state) FILTER (state <> '')::INT AS state_count,
coalesce(arg_min(restaurant_phone, ord) FILTER (restaurant_phone <> ''), '') AS restaurant_phone, coalesce(arg_min({addr}, ord) FILTER (raw_address <> ''), '') AS sample_address, min(ord) AS first_ord FROM resolved GROUP BY {key}"""
_MODE = "modes AS (SELECT {key} AS k, arg_max(state, n * 1000000000 - o) AS primary_state FROM (SELECT {key}, state, count(*) AS n, min(ord) AS o FROM resolved WHERE state <> '' GROUP BY {key}, state) GROUP BY {key})"
_SHOWN = "franchisee_name, name_variants, total_units, brands_operated, brand_count, is_multi_brand, primary_state, all_states, state_count, restaurant_phone, sample_address, first_ord"
_OPS = f"{_COMPS}, {_MODE.format(key='comp')}, rolled AS ({_ROLL.format(key='comp', addr='raw_address')}), ops AS (SELECT * EXCLUDE (primary_state), coalesce(primary_state, '') AS primary_state FROM rolled LEFT JOIN modes USING (k))"


def _ops(spark, d):
    return rollup.operators(resolution.resolve(locations(spark, d), auto=False))


@query(f"WITH {_OPS} SELECT {_SHOWN} FROM ops")
def ag_operators(spark, d):
    """AG1, AR1, TK2: one row per operator."""
    return _ops(spark, d).select(*_SHOWN.split(", "))


_care_addr = f"CASE WHEN zip <> '' THEN trim({D.joined('raw_address', 'city', 'state')} || ' ' || zip) ELSE {D.joined('raw_address', 'city', 'state')} END"


@query(f"WITH resolved AS (SELECT *, lower(trim(franchisee_name)) AS nk FROM {LOC_SQL}), {_MODE.format(key='nk')}, rolled AS ({_ROLL.format(key='nk', addr=_care_addr)}) SELECT {_SHOWN.replace('primary_state', chr(99) + 'oalesce(primary_state, ' + chr(39) * 2 + ') AS primary_state')} FROM rolled LEFT JOIN modes USING (k)")
def ag_care_operators(spark, d):
    """AG2: one row per name whatever the brand, with formatted addresses."""
    return rollup.care_operators(locations(spark, d)).select(*_SHOWN.split(", "))


@query(f"WITH {_OPS} SELECT CASE WHEN total_units < 5 THEN '1-4' WHEN total_units <= 15 THEN '5-15' WHEN total_units <= 200 THEN '16-200' ELSE '201+' END AS bucket, count(*) AS operators, count(*) FILTER (is_multi_brand = 'Yes') AS multi_brand FROM ops GROUP BY 1")
def ag_histogram(spark, d):
    """AG6: operators by size."""
    return rollup.histogram(_ops(spark, d))


@query(
    f"""WITH {_OPS}, t AS (SELECT *, CASE WHEN total_units BETWEEN 16 AND 200 THEN 'A' WHEN total_units BETWEEN 5 AND 15 THEN 'B' END AS tier FROM ops)
SELECT first_ord_key AS franchisee_name, tier, 'tier_' || lower(tier) AS instantly_sequence, CASE WHEN {D.parens(_n)} <> '' THEN {D.parens(_n)} ELSE {_n} END || ' ' || string_split(brands_operated, ' | ')[1] || ' franchisee ' || primary_state AS apollo_search_hint, total_units
FROM (SELECT *, franchisee_name AS first_ord_key FROM t) WHERE tier IS NOT NULL"""
)
def pf_icp(spark, d):
    """PF7, PF8, SO1, AR2: tier A and B rows with outreach columns."""
    return rollup.icp_rows(_ops(spark, d)).select(_n, "tier", "instantly_sequence", "apollo_search_hint", "total_units")


@query(f"WITH resolved AS (SELECT *, lower(trim(franchisee_name)) AS nk FROM {LOC_SQL}), rolled AS ({_ROLL.format(key='nk', addr='raw_address')}) SELECT franchisee_name, total_units FROM rolled WHERE is_multi_brand = 'Yes' ORDER BY total_units DESC, first_ord LIMIT 10")
def tk_multi_brand(spark, d):
    """TK3: the ten largest multi-brand operators (a top-k report)."""
    ops = rollup.care_operators(locations(spark, d))
    return ops.filter("is_multi_brand = 'Yes'").orderBy(c("total_units").desc(), "first_ord").limit(10).select(_n, "total_units")


_REPS = f"reps AS (SELECT brand, franchisee_name, state, ord FROM (SELECT *, row_number() OVER (PARTITION BY brand, lower(trim(franchisee_name)), upper(trim(state)) ORDER BY ord) AS rn FROM {LOC_SQL}) WHERE rn = 1)"


@query(f"WITH {_REPS} SELECT brand, franchisee_name, state, ord FROM reps")
def ag_representatives(spark, d):
    """AG5: first record of each brand, name and state."""
    return resolution.representatives(locations(spark, d)).select("brand", _n, "state", "ord")


@query(
    f"""WITH {_REPS}, s AS (SELECT *, upper(trim(state)) AS st FROM reps)
SELECT 'same_brand' AS scope, a.brand AS key, count(*) AS pairs FROM s a JOIN s b ON a.brand = b.brand AND a.ord < b.ord AND (a.st = b.st OR a.st = '' OR b.st = '') GROUP BY a.brand
UNION ALL SELECT 'cross_brand', a.st, count(*) FROM s a JOIN s b ON a.st = b.st AND a.st <> '' AND a.brand <> b.brand AND a.ord < b.ord GROUP BY a.st"""
)
def j_blocked_pairs(spark, d):
    """Pairs that blocking lets through, by block."""
    pairs = resolution.blocked_pairs(resolution.representatives(locations(spark, d)))
    return pairs.groupBy("scope", F.when(c("scope") == "same_brand", c("a_brand")).otherwise(F.upper(F.trim("a_state"))).alias("key")).agg(F.count("*").alias("pairs"))


_SCORED = D.blocked_scores(_REPS)


@query(f"WITH {_SCORED} SELECT scope, a_ord, b_ord, score FROM scored")
def er_candidates(spark, d):
    """J4, J5, SM3, SM4, TK1: scored candidate pairs."""
    pairs = resolution.candidate_pairs(resolution.representatives(locations(spark, d)))
    return pairs.select("scope", "a_ord", "b_ord", "score")


@query(
    f"""WITH {_SCORED}, routed AS (SELECT scope, a_ord, b_ord, CASE WHEN score >= 96 THEN 'auto' WHEN a_ord % 3 = 0 THEN 'cached' WHEN score >= 85 THEN 'cheap' ELSE 'strong' END AS route FROM scored)
SELECT scope, route, CASE route WHEN 'auto' THEN true WHEN 'cached' THEN b_ord % 2 = 0 AND 60 + b_ord % 40 >= 70 ELSE false END AS accepted, count(*) AS pairs FROM routed GROUP BY 1, 2, 3"""
)
def er_cascade(spark, d):
    """ER4, J6, PF12, ER7: routes of candidate pairs under a table of decisions."""
    pairs = resolution.candidate_pairs(resolution.representatives(locations(spark, d)))
    keyed = resolution.pair_keys(pairs)
    decisions = keyed.filter("score < 96 and a_ord % 3 = 0").select("pair_key", (c("b_ord") % 2 == 0).alias("match"), (60 + c("b_ord") % 40).cast("int").alias("confidence"))
    return resolution.cascade(pairs, decisions).groupBy("scope", "route", "accepted").agg(F.count("*").alias("pairs"))


_CLASSED = f"""CASE WHEN n = '' THEN 'company' WHEN has AND regexp_matches(i, '(?i)^(dba|d/?b/?a)\\b') THEN CASE WHEN {D.company('o')} THEN 'company' END
 WHEN has AND regexp_matches(i, '^\\d+$') THEN CASE WHEN {D.company('o')} THEN 'company' WHEN {D.person('o')} THEN 'person' END
 WHEN has THEN 'company_with_owner' WHEN {D.company('n')} THEN 'company' WHEN regexp_matches(n, '[,/&@#$%]|\\d') THEN NULL WHEN {D.person('n')} THEN 'person' END"""
_TARGET = f"""CASE WHEN n = '' THEN n WHEN has AND regexp_matches(i, '(?i)^(dba|d/?b/?a)\\b') THEN CASE WHEN {D.company('o')} THEN o END
 WHEN has AND regexp_matches(i, '^\\d+$') THEN CASE WHEN {D.company('o')} OR {D.person('o')} THEN o END
 WHEN has THEN i WHEN {D.company('n')} THEN n WHEN regexp_matches(n, '[,/&@#$%]|\\d') THEN NULL WHEN {D.person('n')} THEN n END"""
_AUTO = f"""{_SCORED}, nodes AS (SELECT *, brand || '~' || lower(trim(franchisee_name)) AS nk, {D.owner(_n)} AS ok FROM {LOC_SQL}),
grp AS (SELECT DISTINCT nk, brand || '~' || ok AS gk FROM nodes),
hop AS (SELECT DISTINCT a.nk AS a, b.nk AS b FROM grp a JOIN grp b ON a.gk = b.gk UNION SELECT x.nk, y.nk FROM scored JOIN nodes x ON x.ord = a_ord JOIN nodes y ON y.ord = b_ord WHERE score >= 96 UNION SELECT y.nk, x.nk FROM scored JOIN nodes x ON x.ord = a_ord JOIN nodes y ON y.ord = b_ord WHERE score >= 96),
walk AS (WITH RECURSIVE w(a, b) AS (SELECT DISTINCT nk, nk FROM nodes UNION SELECT w.a, hop.b FROM w JOIN hop ON w.b = hop.a) SELECT a, b FROM w),
low AS (SELECT nk, min(ord) AS o FROM nodes GROUP BY nk), comp AS (SELECT a AS nk, min(o) AS comp FROM walk JOIN low ON b = low.nk GROUP BY a),
resolved AS (SELECT n.*, c.comp FROM nodes n JOIN comp c USING (nk)), {_MODE.format(key='comp')}, rolled AS ({_ROLL.format(key='comp', addr='raw_address')}), ops AS (SELECT * EXCLUDE (primary_state), coalesce(primary_state, '') AS primary_state FROM rolled LEFT JOIN modes USING (k))"""


@query(
    f"""WITH {_AUTO}, t AS (SELECT *, trim(franchisee_name) AS n FROM ops), p AS (SELECT *, {_inner} AS i, {_outer} AS o, regexp_matches(n, '\\([^)]+\\)') AS has FROM t), d AS (SELECT *, {_CLASSED} AS rule_type, {_TARGET} AS rule_target FROM p)
SELECT k AS comp, {_SHOWN}, '' AS apollo_company, '' AS apollo_email, '' AS apollo_linkedin, '' AS apollo_title, CASE WHEN total_units BETWEEN 16 AND 200 THEN 'A' WHEN total_units BETWEEN 5 AND 15 THEN 'B' WHEN total_units > 200 THEN 'large' ELSE 'small' END AS tier,
coalesce(rule_type, 'company') AS entity_type, CASE WHEN rule_type IS NULL THEN 'default' ELSE 'regex' END AS classification_method, coalesce(rule_target, franchisee_name) AS search_target FROM d"""
)
def operator_registry(spark, d):
    """The flagship: raw records through resolution, rollup, tiers and classes."""
    ops = directory.registry(locations(spark, d)).withColumn("tier", rollup.tier_of(c("total_units")))
    return directory.classified(ops)


@query(
    f"""WITH half AS (SELECT franchisee_name || ':' || brand || ':' || state AS h, min(ord) AS o FROM {LOC_SQL} GROUP BY 1),
dec AS (SELECT least(a.h, b.h) AS lo, greatest(a.h, b.h) AS hi FROM half a JOIN half b ON b.o = a.o + 1 WHERE a.o % 40 = 0),
e AS (SELECT x.o AS s, y.o AS t FROM dec JOIN half x ON lo = x.h JOIN half y ON hi = y.h), {_COMPS},
ce AS (SELECT a.comp AS ca, b.comp AS cb FROM e JOIN resolved a ON a.ord = e.s JOIN resolved b ON b.ord = e.t),
sym AS (SELECT ca, cb FROM ce UNION SELECT cb, ca FROM ce),
walk AS (WITH RECURSIVE w(a, b) AS (SELECT DISTINCT comp, comp FROM resolved UNION SELECT w.a, sym.cb FROM w JOIN sym ON w.b = sym.ca) SELECT a, min(b) AS m FROM w GROUP BY a)
SELECT ord, m AS comp FROM resolved JOIN walk ON comp = a"""
)
def er_replay(spark, d):
    """ER6, J7: preview from exact and owner edges and accepted decisions."""
    loc = locations(spark, d)
    half = loc.groupBy(F.concat_ws(":", _n, "brand", "state").alias("h")).agg(F.min("ord").alias("o"))
    nxt = half.select(c("h").alias("h2"), (c("o") - 1).alias("o"))
    decisions = half.filter("o % 40 = 0").join(nxt, "o").select(F.least("h", "h2").alias("key_lo"), F.greatest("h", "h2").alias("key_hi"), F.lit(True).alias("match"))
    return resolution.replay(loc, decisions).select("ord", "comp")


# ---- registry lookup and derivations ----------------------------------------

_LOOK = f"""inputs AS (SELECT ord, trim(franchisee_name) AS entity_name FROM {LOC_SQL} WHERE trim(franchisee_name) <> ''),
ladder AS (SELECT ord, entity_name, unnest(list_concat([entity_name], {D.variants('entity_name')})) AS query, unnest(range(0, 1 + len({D.variants('entity_name')}))) AS rank FROM inputs),
normed AS (SELECT *, {D.similar('query')} AS norm FROM ladder),
look AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY ord, rank) AS rn FROM normed WHERE norm <> '') WHERE rn = 1)"""


def _inputs(spark, d):
    return locations(spark, d).select("ord", c(_n).alias("entity_name"))


@query(f"WITH {_LOOK} SELECT norm, entity_name, query FROM look")
def j_lookup_table(spark, d):
    """J1, ST4: normalised queries, first input and query winning."""
    return lookup.lookup_table(_inputs(spark, d)).select("norm", "entity_name", "query")


@query(f"WITH {_LOOK} SELECT r.rid, l.entity_name, l.query FROM (SELECT *, {D.similar('firm')} AS norm FROM {REG_SQL}) r JOIN look l USING (norm)")
def j_registry_join(spark, d):
    """Every registry record with the input it matches."""
    return lookup.match_all(_inputs(spark, d), registry_rows(spark, d), c("firm")).select("rid", "entity_name", "query")


def _co(spark, d):
    r = registry_rows(spark, d)
    return r.select(c("rid").cast("string").alias("entityid"), c("firm").alias("entityname"), c("status").alias("entitystatus"), c("kind").alias("entitytype"), c("iso").alias("entityformdate"), c("jurisdiction").alias("jurisdictonofformation"), c("first").alias("agentfirstname"), F.lit("").alias("agentmiddlename"), c("last").alias("agentlastname"), F.lit("").alias("agentsuffix"), c("org").alias("agentorganizationname"), *(x.alias(p + n) for p, s in (("principal", "street"), ("mailing", "street"), ("agentprincipal", "street2")) for n, x in (("address1", c(s)), ("address2", F.lit("")), ("city", c("town")), ("state", c("st")), ("zipcode", c("post")))))


_CLEAN = "trim(regexp_replace(firm, ',\\s*(Delinquent|Dissolved|Voluntarily Dissolved|Administratively Dissolved|Withdrawn|Merged|Expired)(\\s+[A-Za-z]+\\s+\\d+,?\\s+\\d{4})?\\s*$', '', 'i'))"
_HINT_CO = "(?i)\\b(dakot|rocky\\s*mountain|new\\s*england|texas|california|florida|nevada|arizona|oregon|washington|illinois|midwest|northwest|southeast|northeast|hawaii|atlantic|rockies)\\b"
_COSCORE = f"""scored AS (SELECT m.*, {D.jaccard(D.similar('entity_name'), D.similar('clean'))} AS sim FROM (SELECT r.*, {_CLEAN} AS clean, l.entity_name, l.query FROM {REG_SQL} r JOIN look l ON {D.similar(_CLEAN)} = l.norm) m),
pts AS (SELECT *, CASE WHEN contains(lower(status), 'good standing') THEN 100.0 WHEN contains(lower(status), 'compliant') OR contains(lower(status), 'active') THEN 80.0 WHEN contains(lower(status), 'delinquent') THEN 0.0 WHEN contains(lower(status), 'administratively') THEN -75.0 WHEN regexp_matches(lower(status), 'dissolved|withdrawn|expired|merged') THEN -50.0 ELSE 50.0 END
 + sim * 100 + CASE WHEN kind LIKE 'F%' AND NOT regexp_matches(entity_name, {D.q(_HINT_CO)}) THEN -30.0 ELSE 0.0 END + CASE WHEN iso LIKE '____-__-__' THEN (iso::DATE - DATE '2000-01-01') * 0.001 ELSE 0.0 END AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY score DESC, rid::VARCHAR) AS rn, count(*) OVER (PARTITION BY entity_name) AS match_count FROM pts)"""


@query(f"WITH {_LOOK}, {_COSCORE} SELECT entity_name, rid::VARCHAR AS entity_number, round(score, 6) AS score, round(sim, 6) AS name_similarity, match_count, query AS query_used FROM ranked WHERE rn = 1")
def w_best_match(spark, d):
    """W1, SM1, SM10, J1: the best Colorado record of each input."""
    best = enrich.best_matches(_inputs(spark, d), _co(spark, d), "co")
    return best.select("entity_name", c("entityid").alias("entity_number"), F.round("score", 6).alias("score"), F.round("name_similarity", 6).alias("name_similarity"), "match_count", c("query").alias("query_used"))


@query(f"WITH {_LOOK}, {_COSCORE} SELECT entity_name, string_agg(rid::VARCHAR || '=' || clean, '; ' ORDER BY rn) AS alternates FROM ranked WHERE rn BETWEEN 2 AND 6 GROUP BY entity_name")
def w_alternates(spark, d):
    """W1, JS4: the next five of each input, in order."""
    best = enrich.best_matches(_inputs(spark, d), _co(spark, d), "co").filter("alternates is not null")
    return best.select("entity_name", F.array_join(F.transform("alternates", lambda a: F.concat_ws("=", a["num"], a["name"])), "; ").alias("alternates"))


_ADDR = D.joined("street", "town", "st", "post")
_AGENT = D.joined("street2", "town", "st", "post")
_MATCH = f"({D.jaccard(D.address('agent'), D.address('principal'))}) >= 0.6"
_ATT = "(?i)\\b(esq|attorney|law)\\b"
_CODERIVE = f"""SELECT entityid, principal, agent, agent_name, CASE WHEN person THEN 'Individual' WHEN org <> '' THEN 'Corporation' ELSE '' END AS agent_type, CASE WHEN agent = '' OR principal = '' THEN '' WHEN m THEN 'True' ELSE 'False' END AS matches,
CASE WHEN person AND m THEN who WHEN person AND NOT regexp_matches(who, '{_ATT}') THEN who || ' (offsite agent)' ELSE '' END AS likely_owner_name,
CASE WHEN regexp_matches(agent_name, '{_ATT}') THEN 'attorney_agent' WHEN kind LIKE 'F%' THEN 'out_of_state_holdco' WHEN person AND m THEN 'owner_operator' WHEN person THEN 'individual_agent_offsite' WHEN agent_name <> '' THEN 'service_agent' ELSE 'unknown' END AS operator_pattern,
CASE kind WHEN 'DLLC' THEN 'Domestic LLC' WHEN 'FLLC' THEN 'Foreign LLC' WHEN 'DPC' THEN 'Domestic Profit Corp' WHEN 'FPC' THEN 'Foreign Profit Corp' ELSE kind END AS entity_type
FROM (SELECT *, CASE WHEN person THEN who ELSE org END AS agent_name, {_MATCH} AS m FROM (SELECT *, who <> '' AND org = '' AS person FROM (SELECT rid::VARCHAR AS entityid, kind, org, trim(first || ' ' || last) AS who, {_ADDR} AS principal, {_AGENT} AS agent FROM {REG_SQL})))"""


@query(_CODERIVE)
def dv_colorado(spark, d):
    """DV5, SM2, MP1, ST14, ST20: derived columns of every Colorado record."""
    out = derive.colorado(_co(spark, d))
    return out.select("entityid", c("principal_address").alias("principal"), c("agent_address").alias("agent"), "agent_name", "agent_type", c("agent_address_matches_principal").alias("matches"), "likely_owner_name", "operator_pattern", "entity_type")


def _ny(spark, d):
    r = registry_rows(spark, d)
    blanks = {"dos_process_name": c("org"), "registered_agent_name": F.lit(""), "ceo_name": c("officer")}
    places = (("location", "street", 2), ("dos_process", "street2", 1), ("registered_agent", "street", 0), ("ceo", "street2", 1))
    cols = [F.when(c("rid") % 2 == 0, x).otherwise("").alias(f"{p}_{n}") if k == 2 else (x if k else F.lit("")).alias(f"{p}_{n}") for p, s, k in places for n, x in (("address_1", c(s)), ("address_2", F.lit("")), ("city", c("town")), ("state", c("st")), ("zip", c("post")))]
    return r.select(c("rid").cast("string").alias("dos_id"), c("firm").alias("current_entity_name"), c("iso").alias("initial_dos_filing_date"), F.lit("KINGS").alias("county"), "jurisdiction", F.when(c("rid") % 9 == 0, "FOREIGN LLC").otherwise("DOMESTIC LLC").alias("entity_type"), *(v.alias(k) for k, v in blanks.items()), *cols)


@query(
    f"""SELECT dos_id, principal_address, agent_address, mailing_address, CASE WHEN agent_address = '' OR principal_address = '' THEN '' WHEN m THEN 'True' ELSE 'False' END AS matches,
CASE WHEN officer <> '' THEN officer WHEN person AND m THEN org ELSE '' END AS likely_owner_name,
CASE WHEN regexp_matches(org, '{_ATT}') THEN 'attorney_agent' WHEN fo THEN 'out_of_state_holdco' WHEN officer <> '' THEN 'owner_operator' WHEN person AND m THEN 'owner_operator' WHEN person THEN 'individual_agent_offsite' WHEN org <> '' THEN 'service_agent' ELSE 'unknown' END AS operator_pattern
FROM (SELECT *, {_MATCH.replace('agent', 'agent_address').replace('principal', 'principal_address')} AS m, officer = '' AND org <> '' AND NOT regexp_matches(org, '(?i)\\b(llc|inc|corp|service|registered|agent|company|co\\.?)\\b') AS person,
CASE WHEN agent_address <> principal_address THEN agent_address ELSE '' END AS mailing_address FROM (SELECT rid::VARCHAR AS dos_id, rid % 9 = 0 AS fo, officer, org, CASE WHEN rid % 2 = 0 THEN {_ADDR} ELSE {_AGENT} END AS principal_address, {_AGENT} AS agent_address FROM {REG_SQL}))"""
)
def dv_new_york(spark, d):
    """DV4: derived columns of every New York record."""
    out = derive.new_york(_ny(spark, d))
    return out.select("dos_id", "principal_address", "agent_address", "mailing_address", c("agent_address_matches_principal").alias("matches"), "likely_owner_name", "operator_pattern")


def fixed_width_lines(r: DataFrame) -> DataFrame:
    """Registry rows as 1440-character lines."""
    f = lambda x, n: F.rpad(x if not isinstance(x, str) else F.lit(x), n, " ")
    head = [(c("rid").cast("string"), 12), (c("firm"), 192), (c("flag"), 1), (c("filing"), 15), (c("street"), 42), ("", 42), (c("town"), 28), (c("st"), 2), (c("post"), 10), ("US", 2), ("", 42), ("", 42), ("", 28), ("", 2), ("", 10), ("", 2), (c("mmddyyyy"), 8), ("59-1", 14), ("N", 1), ("", 8), ("", 41), (c("org"), 42), (F.when(c("rid") % 4 == 0, "P").otherwise("C"), 1), (c("street2"), 42), (c("town"), 28), (c("st"), 2), (c("post"), 9)]
    slot = lambda title, kind, name: [(title, 4), (kind, 1), (name, 42), (c("street"), 42), (c("town"), 28), (c("st"), 2), (c("post"), 9)]
    kind = F.when(c("officer").contains("LLC"), "C").otherwise("P")
    parts = [f(x, n) for x, n in [*head, *slot(c("title"), kind, c("officer")), *slot("P", "P", c("last"))]]
    line = F.rpad(F.concat(*parts), 1440, " ")
    return r.select("rid", once(F.when(c("rid") % 41 == 0, F.substring(line, 1, 1200)).otherwise(line)).alias("value"))


_OFF = "CASE WHEN officer <> '' AND officer NOT LIKE '%LLC%' THEN CASE WHEN last <> '' AND title <> 'P' THEN last ELSE officer END ELSE last END"


@query(
    f"""SELECT rid, rid::VARCHAR AS entity_number, trim(firm) AS name, CASE WHEN flag = 'A' THEN 'Active' ELSE 'Inactive' END AS status, ((officer <> '')::INT + (last <> '')::INT) AS officers, {_OFF} AS likely_owner_name,
{D.city_line('street', 'town', 'st', 'post')} AS principal_address, substr(mmddyyyy, 1, 2) || '/' || substr(mmddyyyy, 3, 2) || '/' || substr(mmddyyyy, 5, 4) AS formation_date,
CASE WHEN filing LIKE 'FOR%' THEN 'Out-of-state' ELSE 'Florida' END AS jurisdiction, CASE WHEN regexp_matches(org, '{_ATT}') THEN 'attorney_agent' WHEN filing LIKE 'FOR%' THEN 'out_of_state_holdco' WHEN {_OFF} <> '' THEN 'owner_operator' WHEN org <> '' AND rid % 4 <> 0 THEN 'service_agent' ELSE 'unknown' END AS operator_pattern
FROM {REG_SQL} WHERE rid % 41 <> 0"""
)
def sc_fixed_width(spark, d):
    """SC8, TK6, AR3, DV3: fixed-width lines parsed and derived; short lines dropped."""
    out = derive.florida(readers.cordata(fixed_width_lines(registry_rows(spark, d))))
    return out.select("rid", "entity_number", c("first_result_name").alias("name"), "status", F.size("officers").alias("officers"), "likely_owner_name", "principal_address", "formation_date", "jurisdiction", "operator_pattern")


@query(
    f"""WITH t AS (SELECT rid, {D.address(_ADDR)} AS pa, lower(trim(officer)) AS w FROM {REG_SQL}), p AS (SELECT pa, count(*) AS n FROM t WHERE pa <> '' GROUP BY pa), o AS (SELECT w, count(*) AS n FROM t WHERE w <> '' GROUP BY w)
SELECT rid, CASE WHEN coalesce(p.n, 0) > 1 OR coalesce(o.n, 0) > 1 THEN 'True' WHEN t.pa <> '' OR t.w <> '' THEN 'False' ELSE '' END AS multi_entity_operator FROM t LEFT JOIN p ON t.pa = p.pa LEFT JOIN o ON t.w = o.w"""
)
def dv_shared_owner(spark, d):
    """J10, AG3, DV6: rows that share an address or an owner."""
    r = registry_rows(spark, d).select("rid", N.join_parts(c("street"), c("town"), c("st"), c("post")).alias("principal_address"), c("officer").alias("likely_owner_name"))
    return derive.shared_signals(r).select("rid", "multi_entity_operator")


@query(
    f"""WITH t AS (SELECT rid, {D.address(_ADDR)} AS pa, CASE WHEN rid % 3 = 0 THEN lower(trim(officer)) ELSE '' END AS w FROM {REG_SQL}), p AS (SELECT pa, count(*) AS n FROM t WHERE pa <> '' GROUP BY pa), o AS (SELECT w, count(*) AS n FROM t WHERE w <> '' GROUP BY w)
SELECT rid, array_to_string(list_filter([CASE WHEN p.n > 1 THEN 'shared_principal_address:' || p.n END, CASE WHEN o.n > 1 THEN 'shared_agent:' || o.n END], lambda x: x IS NOT NULL), '; ') AS multi_entity_operator FROM t LEFT JOIN p ON t.pa = p.pa LEFT JOIN o ON t.w = o.w"""
)
def dv_shared_agent(spark, d):
    """AG3, DV6: the California form of shared signals."""
    r = registry_rows(spark, d).select("rid", N.join_parts(c("street"), c("town"), c("st"), c("post")).alias("principal_address"), c("officer").alias("agent_name"), F.when(c("rid") % 3 == 0, "True").otherwise("False").alias("agent_is_individual"))
    return derive.shared_signals(r, "ca").select("rid", "multi_entity_operator")


def _page(r: DataFrame) -> DataFrame:
    tx = F.concat_ws("\n", F.lit("Taxpayer Number:"), c("rid").cast("string"), F.lit("Mailing Address:"), c("street"), F.concat_ws(", ", "town", "st"), F.lit("Right to Transact Business in Texas:"), F.lit("ACTIVE"), F.lit("State of Formation:"), F.when(c("jurisdiction") == "", "TX").otherwise(c("jurisdiction")), F.lit("SOS Registration Status"), F.lit("(SOS status updated each business day):"), c("status"), F.lit("Registered Agent Name:"), F.when(c("officer") == "", "NONE INC").otherwise(c("officer")), F.lit("Registered Office Street Address:"), c("street2"), F.lit("Public Information Report"), F.lit("x"))
    return r.select("rid", tx.alias("text"))


@query(
    f"""SELECT rid, rid::VARCHAR AS taxpayer_number, street || ', ' || CASE WHEN town = '' THEN ', ' || st ELSE town || ', ' || st END AS mailing_address, CASE WHEN jurisdiction = '' THEN 'TX' ELSE jurisdiction END AS jurisdiction, status AS sos_registration_status,
CASE WHEN officer = '' THEN 'NONE INC' ELSE officer END AS agent_name, street2 AS agent_address, CASE WHEN jurisdiction NOT IN ('TX', '') THEN 'out_of_state_holdco' WHEN officer <> '' AND officer NOT LIKE '%LLC%' THEN CASE WHEN ({D.jaccard(D.address('street2'), D.address("(street || ', ' || CASE WHEN town = '' THEN ', ' || st ELSE town || ', ' || st END)"))}) >= 0.6 THEN 'owner_operator' ELSE 'individual_agent_offsite' END ELSE 'service_agent' END AS operator_pattern FROM {REG_SQL}"""
)
def dv_texas(spark, d):
    """DV9, DV2: Texas detail pages parsed and derived."""
    pages = _page(registry_rows(spark, d))
    out = derive.texas(pages.select("rid", *(v.alias(k) for k, v in captured.tx_detail(c("text")).items())).withColumn("principal_address", F.lit("")))
    return out.select("rid", "taxpayer_number", "mailing_address", "jurisdiction", "sos_registration_status", "agent_name", "agent_address", "operator_pattern")


@query(
    f"""SELECT rid, street || ', ' || st AS principal_address, 'Individual' = CASE WHEN rid % 2 = 0 THEN 'Individual' ELSE 'Registered Corporate' END AS individual, CASE WHEN rid % 2 = 0 THEN street2 ELSE '' END AS agent_address, 'Good' AS standing_sos,
CASE WHEN officer = '' OR rid % 2 = 1 THEN '' WHEN ({D.jaccard(D.address('street2'), D.address("(street || ', ' || st)"))}) >= 0.6 THEN officer WHEN NOT regexp_matches(officer, '{_ATT}') THEN officer || ' (no addr match)' ELSE '' END AS likely_owner_name FROM {REG_SQL}"""
)
def dv_california(spark, d):
    """DV8, DV1: California drawers parsed and derived."""
    r = registry_rows(spark, d)
    drawer = F.concat(F.lit("Principal Address\t"), c("street"), F.lit("\n"), c("st"), F.lit("\nAgent\t"), F.when(c("rid") % 2 == 0, "Individual").otherwise("Registered Corporate"), F.lit("\n"), c("officer"), F.lit("|\n"), c("street2"), F.lit("\nStanding - SOS\tGood\nHistory\nx"))
    parsed = r.select("rid", c("officer").alias("agent_name"), c("kind").alias("entity_type"), *(v.alias(k) for k, v in captured.ca_drawer(drawer).items()))
    out = derive.california(parsed)
    return out.select("rid", "principal_address", (c("agent_is_individual") == "True").alias("individual"), "agent_address", "standing_sos", "likely_owner_name")


@query(f"""SELECT rid, firm || ' (' || (100000 + rid) || ')' AS first_result_name, (100000 + rid)::VARCHAR AS entity_number, CASE WHEN rid % 3 = 0 THEN '' ELSE '01/02/2020' END AS formation_date, CASE WHEN rid % 3 = 0 THEN '' ELSE 'Active' END AS status, CASE WHEN rid % 3 = 0 THEN '' ELSE 'PAT DOE' END AS agent_name FROM {REG_SQL}""")
def sc_result_rows(spark, d):
    """SC14: captured result rows."""
    text = F.concat(c("firm"), F.lit(" ("), (100000 + c("rid")).cast("string"), F.lit(")\nClick to expand\n01/02/2020\tActive\tLLC\tCALIFORNIA\t"), F.when(c("rid") % 3 == 0, "").otherwise("PAT DOE"))
    out = registry_rows(spark, d).select("rid", *(v.alias(k) for k, v in captured.ca_row(text).items()))
    return out.select("rid", "first_result_name", "entity_number", "formation_date", "status", "agent_name")


@query(
    f"""SELECT rid, firm AS name, CASE WHEN rid % 2 = 0 THEN lpad(rid::VARCHAR, 11, '3') ELSE 'n' || rid END AS taxpayer_number, st AS zip FROM {REG_SQL} WHERE rid % 7 <> 0"""
)
def sc_html_rows(spark, d):
    """SC15: table rows of result pages."""
    html = F.concat(F.lit('<table><tr><th>h</th></tr><tr class="r"><td><a href="/s/'), F.when(c("rid") % 2 == 0, F.lpad(c("rid").cast("string"), 11, "3")).otherwise("x"), F.lit('">'), c("firm"), F.lit("</a></td><td>n"), c("rid").cast("string"), F.lit("</td>"), F.when(c("rid") % 7 == 0, "").otherwise(F.concat(F.lit("<td> "), c("st"), F.lit(" </td>"))), F.lit("</tr></table>"))
    return readers.taxpayer_rows(readers.html_rows(registry_rows(spark, d).select("rid", html.alias("html")))).select("rid", "name", "taxpayer_number", "zip")


@query(f"WITH {_LOOK} SELECT i.ord, i.entity_name, coalesce(m.n, 0) AS match_count FROM (SELECT ord, franchisee_name AS entity_name FROM {LOC_SQL}) i LEFT JOIN (SELECT l.entity_name, count(*) AS n FROM (SELECT *, {D.similar('firm')} AS norm FROM {REG_SQL}) r JOIN look l USING (norm) GROUP BY 1) m USING (entity_name)")
def j_left_completion(spark, d):
    """Every input, matched or not."""
    inputs = _inputs(spark, d)
    m = lookup.match_all(inputs, registry_rows(spark, d), c("firm")).groupBy("entity_name").agg(F.count("*").alias("match_count"))
    return lookup.complete(inputs, m).select("ord", "entity_name", "match_count")


@query()
def j_enriched_florida(spark, d):
    """DV3, W1, SM8, J2, DV6, PF9: inputs through the whole Florida enrichment, universal columns."""
    reg = readers.cordata(fixed_width_lines(registry_rows(spark, d))).drop("rid")
    return enrich.enrich(_inputs(spark, d), reg, "fl")


@query(
    f"""WITH ask AS (SELECT franchisee_name AS entity_name, min(ord) AS ord FROM {LOC_SQL} GROUP BY 1), reg AS (SELECT firm, norm FROM (SELECT DISTINCT firm, {D.similar('firm')} AS norm FROM {REG_SQL}) WHERE norm <> ''),
ladder AS (SELECT ord, entity_name, unnest(list_concat([entity_name], {D.variants('entity_name')})) AS query, unnest(range(0, 1 + len({D.variants('entity_name')}))) AS rank FROM ask),
hits AS (SELECT l.ord, l.entity_name, l.query, l.rank, reg.firm FROM ladder l JOIN reg ON {D.similar('l.query')} = reg.norm), firsts AS (SELECT ord, min(rank) AS rank FROM hits GROUP BY ord),
lone AS (SELECT ord, entity_name, {D.similar('entity_name')} AS n1 FROM ask WHERE ord NOT IN (SELECT ord FROM firsts))
SELECT ord, entity_name, firm AS found, query AS label FROM hits JOIN firsts USING (ord, rank)
UNION ALL SELECT ord, entity_name, firm, 'FUZZY:' || string_split(n1, ' ')[1] FROM lone JOIN reg ON string_split(n1, ' ')[1] = string_split(norm, ' ')[1] AND n1 <> '' WHERE ({D.jaccard('n1', 'norm')}) >= 0.5"""
)
def j_fuzzy_fallback(spark, d):
    """Variants first, then records with the same first token."""
    few = registry_rows(spark, d).select("firm").distinct()
    return lookup.fuzzy_fallback(locations(spark, d).groupBy(c(_n).alias("entity_name")).agg(F.min("ord").alias("ord")), few, "firm")


# ---- ordered operators -------------------------------------------------------

_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents)"


@query(
    f"""WITH {_LINES}, p AS (SELECT doc_id, line_no + 1 AS page_no, len(string_split(text, ' ')) % 11 AS score FROM lines),
hot AS (SELECT *, CASE WHEN page_no - lag(page_no) OVER (PARTITION BY doc_id ORDER BY page_no) <= 3 THEN 0 ELSE 1 END AS opens FROM p WHERE score >= 5),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY page_no) AS run FROM hot),
spans AS (SELECT doc_id, run, min(page_no) AS s, max(page_no) AS e FROM runs GROUP BY 1, 2),
tot AS (SELECT x.doc_id, x.s, x.e, sum(p.score) AS total FROM spans x JOIN p ON p.doc_id = x.doc_id AND p.page_no BETWEEN x.s AND x.e GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, s) AS rn FROM tot)
SELECT doc_id, greatest(1, s - 1)::INT AS start_page, least(e + 1, (SELECT max(page_no) FROM p WHERE p.doc_id = best.doc_id))::INT AS end_page, total::BIGINT AS total FROM best WHERE rn = 1 AND total >= 20"""
)
def w_densest_run(spark, d):
    """W2, W3, AG10: the densest run of pages, padded."""
    lines = ordered.lines_of(tbl(spark, d, "documents"))
    pages = lines.select("doc_id", (c("line_no") + 1).alias("page_no"), (F.size(F.split("text", " ")) % 11).cast("long").alias("score"))
    return ordered.densest_run(pages)


@query(
    f"""WITH {_LINES}, h AS (SELECT *, unnest(range(greatest(0, floor((line_no - 4) / 2.0)::BIGINT + 1), line_no // 2 + 1)) AS batch FROM lines)
SELECT doc_id, batch, count(*) AS lines, length(regexp_replace(string_agg(text, chr(10) ORDER BY line_no), '^\\s+|\\s+$', '', 'g')) AS chars FROM h GROUP BY 1, 2 HAVING chars >= 50"""
)
def w_hopping(spark, d):
    """W5, PF5: overlapping batches of lines, thin ones dropped."""
    lines = ordered.lines_of(tbl(spark, d, "documents"))
    return ordered.skip_thin(ordered.hopping(lines, 4, 2))


@query(f"WITH {_LINES} SELECT doc_id, line_no // 5 AS batch, count(*) AS lines, min(line_no) AS first_line FROM lines GROUP BY 1, 2")
def w_tumbling(spark, d):
    """Consecutive batches of lines."""
    lines = ordered.tumbling(ordered.lines_of(tbl(spark, d, "documents")), 5)
    return lines.groupBy("doc_id", "batch").agg(F.count("*").alias("lines"), F.min("line_no").alias("first_line"))


@query(f"SELECT ord, coalesce(last_value(CASE WHEN state <> '' THEN state END IGNORE NULLS) OVER (PARTITION BY brand ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS filled FROM {LOC_SQL}")
def w_forward_fill(spark, d):
    """A blank state takes the one before it."""
    return ordered.forward_fill(locations(spark, d), "state", ["brand"], "ord", "filled").select("ord", "filled")


@query(f"WITH {_LINES}, m AS (SELECT doc_id, min(line_no) FILTER (contains(text, ' | ') OR contains(text, '!!')) AS stop FROM lines GROUP BY 1) SELECT doc_id, line_no, md5(text) AS h FROM lines JOIN m USING (doc_id) WHERE stop IS NULL OR line_no < stop")
def w_take_while(spark, d):
    """Lines before the first marker."""
    return ordered.take_while(ordered.lines_of(tbl(spark, d, "documents")), (" | ", "!!")).select("doc_id", "line_no", F.md5(c("text").cast("binary")).alias("h"))


@query(
    f"""WITH {_LINES}, s AS (SELECT doc_id, min(line_no) AS st FROM lines WHERE length(trim(text)) < 100 AND contains(upper(text), 'TION') GROUP BY 1)
SELECT s.doc_id, s.st AS start, coalesce(min(l.line_no) FILTER (l.line_no BETWEEN s.st + 2 AND s.st + 39999 AND length(trim(l.text)) BETWEEN 1 AND 79 AND regexp_matches(upper(trim(l.text)), '(ING\\b)|(^DE)')), least(s.st + 40000, max(l.line_no) + 1)) AS "end" FROM s JOIN lines l USING (doc_id) GROUP BY 1, 2"""
)
def w_section(spark, d):
    """The section from a keyword to the first closing line."""
    lines = ordered.lines_of(tbl(spark, d, "documents"))
    return ordered.section_end(lines, ordered.section_start(lines, "tion"), (r"ING\b", "^DE"), skip=2)


@query(f"WITH {_LINES}, v AS (SELECT DISTINCT doc_id, line_no // 3 AS chunk FROM lines) SELECT doc_id, greatest(0, min(chunk) * 3 - 2) AS start FROM v WHERE (doc_id + chunk) % 4 = 0 AND 60 + (doc_id * 7 + chunk) % 40 >= 85 GROUP BY 1")
def w_first_chunk(spark, d):
    """The first chunk that a verdict accepts."""
    lines = ordered.lines_of(tbl(spark, d, "documents"))
    v = lines.select("doc_id", F.floor(c("line_no") / 3).cast("long").alias("chunk")).distinct()
    verdicts = v.select("doc_id", "chunk", ((c("doc_id") + c("chunk")) % 4 == 0).alias("found"), (60 + (c("doc_id") * 7 + c("chunk")) % 40).alias("confidence"))
    return ordered.first_accepted_chunk(lines, verdicts, 3, back=2)


@query(f"WITH {_LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS rn FROM lines) SELECT doc_id, bool_or(contains(text, 'tion')) AS found FROM r WHERE rn <= 2 GROUP BY 1")
def w_last_lines(spark, d):
    """Whether the last lines hold a marker."""
    return ordered.last_lines_hold(ordered.lines_of(tbl(spark, d, "documents")), "tion", 2)


@query("SELECT event_type, count(*) AS n, min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def ag_latency(spark, d):
    """AG8, AG9, MA1: counts, extremes and interpolated percentiles."""
    s = rollup.latency_stats(tbl(spark, d, "events"), "event_type", "value")
    return s.select("event_type", "n", "min", "max", *(F.round(x, 6).alias(x) for x in ("avg", "p50", "p90", "p95")))


@query(f"SELECT brand, file, count(*) AS records FROM {LOC_SQL} GROUP BY GROUPING SETS ((brand, file), ())")
def ag_file_summary(spark, d):
    """AG11: records by brand and file with a total."""
    return rollup.file_summary(locations(spark, d))


@query(
    f"""WITH t AS (SELECT CASE WHEN n = '' THEN 'company' WHEN regexp_matches(n, '\\(') THEN 'paren' ELSE 'plain' END AS shape, n FROM (SELECT trim(franchisee_name) AS n FROM {LOC_SQL})) SELECT shape, count(*) AS names, count(DISTINCT lower(n)) AS spellings FROM t GROUP BY shape"""
)
def ag_by_shape(spark, d):
    """AG7: counts by kind of name."""
    return rollup.by_shape(locations(spark, d), _n)


# ---- sets, sinks, catalogue, filings ----------------------------------------


@query(
    f"""SELECT brand, franchisee_name, raw_address, city, zip, ord FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(brand)), lower(trim(franchisee_name)), lower(trim(raw_address)), lower(trim(city)), lower(trim(zip)) ORDER BY nw, ord) AS rn FROM (SELECT *, (ord % 2 = 0)::INT AS nw FROM {LOC_SQL} UNION ALL SELECT *, 1 FROM {LOC_SQL} WHERE ord % 5 = 0)) WHERE rn = 1"""
)
def sk_upsert(spark, d):
    """SK3, SO1, SR4: old and new records merged, the first of each key."""
    loc = locations(spark, d)
    new = loc.filter("ord % 2 = 0").unionByName(loc.filter("ord % 5 = 0"))
    return sinks.dedupe_first(loc.filter("ord % 2 = 1"), new).select("brand", _n, "raw_address", "city", "zip", "ord")


@query(
    """WITH t AS (SELECT p_partkey AS ord, p_brand || ' ' || p_type AS name, regexp_replace(lower(p_brand || p_type), '[^a-z0-9]', '', 'g') AS k FROM part), seed AS (SELECT * FROM t WHERE ord % 4 = 0)
SELECT name, 'seed' AS source, ord FROM seed UNION ALL SELECT name, 'new', ord FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ord) AS rn FROM t WHERE ord % 4 <> 0 AND k NOT IN (SELECT k FROM seed)) WHERE rn = 1"""
)
def dv_catalogue(spark, d):
    """J12, SO5, SO2, DV13: a catalogue with new names that its keys lack."""
    t = tbl(spark, d, "part").select(c("p_partkey").alias("ord"), F.concat_ws(" ", "p_brand", "p_type").alias("name"))
    return derive.merge_catalogue(t.filter("ord % 4 = 0"), t.filter("ord % 4 <> 0"), N.brand_key(c("name"))).select("name", "source", "ord")


@query("""SELECT p_partkey AS ord, CASE WHEN p_size % 3 = 0 THEN 'other' WHEN p_size % 3 = 1 THEN 'pizza' ELSE 'burger|pizza' END AS tags FROM part""")
def dv_categorise(spark, d):
    """DV12: tags from a table, of a closed vocabulary, other by default."""
    t = tbl(spark, d, "part").select(c("p_partkey").alias("ord"), c("p_size").alias("key"))
    tags = t.select("key").distinct().filter("key % 3 <> 0").withColumn("tags", F.when(c("key") % 3 == 1, F.array(F.lit("pizza"), F.lit("nonsense"))).otherwise(F.array(F.lit("burger"), F.lit("pizza"))))
    return derive.categorise(t, tags, ("pizza", "burger")).select("ord", F.array_join("tags", "|").alias("tags"))


@query("""SELECT name, score FROM (SELECT p_name || ' ' || p_partkey AS name, (len(list_intersect(list_distinct(string_split(lower(p_type), ' ')), ['brass', 'small', 'steel'])))::INT AS score FROM part) WHERE score > 0 ORDER BY score DESC, name LIMIT 20""")
def dv_expand(spark, d):
    """DV11: brands by tag overlap (a top-k report)."""
    b = tbl(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("name"), F.split(F.lower("p_type"), " ").alias("tags"))
    return derive.expand_by_tags(b, ["brass", "small", "steel"]).select("name", "score")


def _filings(spark, d):
    r = registry_rows(spark, d)
    asked = F.element_at(F.split("firm", " "), 1)
    return r.select(asked.alias("requested"), c("rid").alias("ord"), (c("rid") % 3 != 0).alias("fddAvailable"), F.concat(F.lit("http://x/"), "rid", F.lit(".pdf")).alias("fddPdfUrl"), c("firm").alias("tradeName"), F.lit("").alias("legalName"), F.when(c("rid") % 2 == 0, "Registered").otherwise("Expired").alias("status"), c("iso").alias("effectiveDate"), c("rid").cast("string").alias("fileNumber"))


_ASK = "string_split(firm, ' ')[1] AS requested"


@query(
    f"""SELECT requested, url FROM (SELECT {_ASK}, 'http://x/' || rid || '.pdf' AS url, row_number() OVER (PARTITION BY string_split(firm, ' ')[1] ORDER BY (rid % 2 = 0) DESC, CASE WHEN iso LIKE '____-__-__' THEN iso::DATE END DESC NULLS LAST, rid) AS rn FROM {REG_SQL} WHERE rid % 3 <> 0) WHERE rn = 1"""
)
def tk_wisconsin(spark, d):
    """TK4, PF13, SM5: the best filing of each request; each request is part of its items' names."""
    return filings.pick_wisconsin(_filings(spark, d)).select("requested", "url")


@query(
    f"""SELECT requested, url FROM (SELECT {_ASK}, 'http://m/' || rid AS url, row_number() OVER (PARTITION BY string_split(firm, ' ')[1] ORDER BY rid % 4, CASE WHEN iso LIKE '____-__-__' THEN iso::DATE END DESC NULLS LAST, (1990 + rid % 30)::VARCHAR DESC, rid) AS rn FROM {REG_SQL} WHERE rid % 4 < 3) WHERE rn = 1"""
)
def tk_minnesota(spark, d):
    """TK4, TK5, PF13: the best filing by type, date and year."""
    r = registry_rows(spark, d)
    kind = F.element_at(F.array(*map(F.lit, ("Clean FDD", "Final FDD", "Marked FDD", "Letter"))), (c("rid") % 4 + 1).cast("int"))
    items = r.select(F.element_at(F.split("firm", " "), 1).alias("requested"), c("rid").alias("ord"), kind.alias("documentType"), F.concat(F.lit("http://m/"), "rid").alias("documentUrl"), c("firm").alias("franchiseName"), F.lit("").alias("franchisor"), c("iso").alias("receivedDate"), (1990 + c("rid") % 30).alias("year"), c("rid").cast("string").alias("fileNumber"))
    return filings.pick_minnesota(items).select("requested", "url")


@query(f"""SELECT requested, url FROM (SELECT {_ASK}, rid, CASE WHEN rid % 5 = 1 THEN 'http://c/' || rid || '.PDF' ELSE 'http://c/doc' || rid END AS url, row_number() OVER (PARTITION BY string_split(firm, ' ')[1] ORDER BY rid) AS rn FROM {REG_SQL} WHERE rid % 5 IN (1, 2)) WHERE rn = 1""")
def pf_document_link(spark, d):
    """PF14: the first field that looks like a document link."""
    r = registry_rows(spark, d)
    m = F.create_map(F.lit("home"), F.when(c("rid") % 5 == 1, F.concat(F.lit("http://c/"), "rid", F.lit(".PDF"))).otherwise(F.concat(F.lit("http://c/"), "rid")), F.lit("documentLink"), F.when(c("rid") % 5 == 2, F.concat(F.lit("http://c/doc"), "rid")).otherwise("none"))
    return filings.pick_california(r.select(F.element_at(F.split("firm", " "), 1).alias("requested"), c("rid").alias("ord"), m.alias("fields")))


@query("""SELECT 'k' || c_custkey AS requested, CASE WHEN c_custkey % 2 = 0 THEN 'wi' WHEN c_custkey % 3 = 0 THEN 'mn' WHEN c_custkey % 5 = 0 THEN 'ca' END AS source, CASE WHEN c_custkey % 2 = 0 THEN 'wi: n' WHEN c_custkey % 3 = 0 THEN 'wi: n; mn: n' ELSE 'wi: n; mn: n; ca: n' END AS notes FROM customer""")
def dv_source_chain(spark, d):
    """DV15: the first source with a document, and the notes so far."""
    cust = tbl(spark, d, "customer").select("c_custkey")
    src = F.explode(F.array(*(F.struct(F.lit(s).alias("source"), (c("c_custkey") % n == 0).alias("has")) for s, n in (("ca", 5), ("wi", 2), ("mn", 3)))))
    t = cust.select("c_custkey", src.alias("s")).select(F.concat(F.lit("k"), "c_custkey").alias("requested"), "s.source", F.when(c("s.has"), "u").otherwise("").alias("url"), F.concat("s.source", F.lit(": n")).alias("note"))
    return filings.first_source(t).select("requested", "source", "notes")


@query(f"WITH {_LINES} SELECT doc_id, md5(string_agg(text, chr(10) ORDER BY line_no)) AS content_hash, CASE WHEN doc_id % 3 = 0 THEN 250 ELSE 0 END::BIGINT AS next_batch_start FROM lines GROUP BY doc_id")
def sr_resume(spark, d):
    """SK7, SR2, ST22: where to resume each document, by content hash."""
    now = sinks.progress(ordered.lines_of(tbl(spark, d, "documents")))
    saved = now.select("doc_id", F.when(c("doc_id") % 3 == 0, c("content_hash")).otherwise("old").alias("content_hash"), F.lit(250).alias("next_batch_start"))
    return now.join(sinks.resume_from(now, saved), "doc_id")


@query("SELECT c_custkey AS k, 'SINGLE_RESULT|' || c_name || '|' || c_nationkey AS line, c_nationkey::VARCHAR AS n FROM customer")
def sk_result_lines(spark, d):
    """SK10: result lines written and read."""
    t = tbl(spark, d, "customer").select(c("c_custkey").alias("k"), sinks.result_line("SINGLE_RESULT", c("c_name"), c("c_nationkey").cast("string")).alias("line"))
    return t.select("k", "line", F.get(sinks.read_result_line(c("line")), F.lit(2)).alias("n"))


@query("SELECT p.doc_id, p.page_no, r.brand FROM (SELECT url AS doc_id, (page_id % 9 + 1)::INT AS page_no FROM pages) p JOIN (SELECT DISTINCT url AS doc_id, 'B' AS brand FROM pages) r USING (doc_id) WHERE p.page_no BETWEEN 2 AND 6")
def sc_page_ranges(spark, d):
    """SC2, SC3: pages within their file's configured range."""
    p = tbl(spark, d, "pages").select(c("url").alias("doc_id"), (c("page_id") % 9 + 1).cast("int").alias("page_no"))
    ranges = p.select(c("doc_id").alias("file_name")).distinct().withColumns({"start_page": F.lit(2), "end_page": F.lit(6), "brand": F.lit("B")})
    return readers.pages_in_range(p, ranges)
