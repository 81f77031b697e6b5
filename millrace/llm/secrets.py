"""Multipart credential linking (operator 4), native.

Base spans of three kinds are always reported: ``assign`` (a secret word, a separator
and a value of 8 or more), ``access`` (AKIA identifiers of 16 or more) and ``hex`` (runs
of 32 or more). Weak candidates are parts that mean little alone: ``identifier`` (a
named account or client id), ``secret`` (a bare run of 20 or more with a letter and a
digit) and ``endpoint`` (a URL with a host). They are interval-joined within the scope
of their document: a weak part is reported only if a complementary part lies within
``reach`` code points of it (secrets need an identifier, access id or endpoint;
identifiers and endpoints need a secret). Weak parts inside a base span are that span.

All work is per row, on arrays of the row's parts: no shuffle, no key that can be hot.
The weak patterns run only over texts that can hold both sides of a link. The interval join
of one row sorts its parts once and merges both sides in a pass forwards, which carries how
far the other side reaches, and one backwards, which carries where it next begins. Passes
over n parts gather their results in chunks of about sqrt(n), since arrays are copied as
they grow.

Defined results: null text is empty text; an empty table gives no rows; null ids and
repeated rows keep their own row; every column of docs comes back as it was (``redact``
changes text, and n_chars where there is one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole

#: Fixed patterns of the base kinds; ASCII letters in either case for the words of ASSIGN.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENTIFIER = r"""(?i:client_id|access_key_id|account_id|username|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
SECRET = r"[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = r"[a-z][a-z0-9+]*://[A-Za-z0-9._:@-]+"
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
REACH = 200

_PART = "array<struct<start:int,kind:int,end:int>>"


def _gather(items: str, zero: str, advance, emit, kind: str) -> str:
    """SQL: what ``emit(state, item)`` gives for each item in order, in one array; ``advance(state, item)`` carries the state on. (Text, since so large a tree of Column objects takes the driver long to build.)"""
    width = "greatest(cast(ceil(sqrt(size(v_))) as int), 1)"
    chunks = f"transform(sequence(0, cast(floor((size(v_) - 1) / {width}) as int)), i_ -> slice(v_, i_ * {width} + 1, {width}))"
    # The state at the start of each chunk, then each chunk on its own.
    starts = f"aggregate(parts_, array({zero}), (acc_, part_) -> concat(acc_, array(aggregate(part_, element_at(acc_, -1), (s_, x_) -> {advance('s_', 'x_')}))))"
    first = f"named_struct('state', get(at_, k_), 'out', cast(array() as {kind}))"
    own = f"aggregate(p_, {first}, (a_, y_) -> named_struct('state', {advance('a_.state', 'y_')}, 'out', concat(a_.out, {emit('a_.state', 'y_')})), a_ -> a_.out)"
    body = f"element_at(transform(array({starts}), at_ -> flatten(transform(parts_, (p_, k_) -> {own}))), 1)"
    return f"element_at(transform(array({items}), v_ -> if(size(v_) > 0, element_at(transform(array({chunks}), parts_ -> {body}), 1), cast(array() as {kind}))), 1)"


def _with_found(docs: DataFrame, name: str, pattern: str, kind: int, maybe: Column, keep=None) -> DataFrame:
    """Add spans (start, kind, end) of the leftmost non-overlapping matches in ``t``, in code points, of texts where ``maybe`` holds.

    Matches and the pieces between them alternate, so their lengths give the places.
    """
    hits = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
    lengths = lambda x: F.transform(x, lambda s: F.length(s))
    good = F.transform(hits, (lambda s: F.coalesce(keep(s), F.lit(False))) if keep else (lambda s: F.lit(True)))
    pairs = F.arrays_zip(lengths(F.split("t", pattern, -1)).alias("gap"), lengths(hits).alias("hit"), good.alias("good"))
    end = lambda at, x: f"{at} + {x}.gap + coalesce({x}.hit, 0)"
    span = lambda at, x: f"if(coalesce({x}.good, false), array(named_struct('start', {at} + {x}.gap, 'kind', {kind}, 'end', {end(at, x)})), cast(array() as {_PART}))"
    return docs.withColumn("pairs", F.when(maybe, pairs)).withColumn(name, F.expr(_gather("pairs", "0", end, span, _PART))).drop("pairs")


def _chosen(weak: str, other: str, reach: int, near: bool) -> Column:
    """The weak spans that are at most ``reach`` apart from another span (-1: overlap it), or those that are not."""
    told = "array<struct<start:int,kind:int,end:int,weak:boolean,near:boolean>>"
    new = lambda s, weak, near: f"named_struct('start', {s}.start, 'kind', {s}.kind, 'end', {s}.end, 'weak', {weak}, 'near', {near})"
    parts = f"array_sort(concat(transform({weak}, w_ -> {new('w_', 'true', 'false')}), transform({other}, w_ -> {new('w_', 'false', 'false')})))"

    def passed(items: str, zero: str, better: str, place: str, reached) -> str:
        """Items with ``near`` set where the other side, whose best place so far is the state, reaches them."""
        emit = lambda at, s: f"array({new(s, f'{s}.weak', f'({s}.near or ({s}.weak and {reached(at, s)}))')})"
        return _gather(items, zero, lambda at, s: f"if({s}.weak, {at}, {better}({at}, {s}.{place}))", emit, told)

    forward = passed(parts, f"{-(1 << 30)}", "greatest", "end", lambda at, s: f"{s}.start <= {at} + {reach}")
    back = passed(f"reverse({forward})", f"{1 << 30}", "least", "start", lambda at, s: f"{at} <= {s}.end + {reach}")
    plain = f"transform(filter({back}, s_ -> s_.weak and s_.near = {str(near).lower()}), s_ -> named_struct('start', s_.start, 'kind', s_.kind, 'end', s_.end))"
    alone = f"cast(array() as {_PART})" if near else weak
    return F.expr(f"if(size({weak}) > 0 and size({other}) > 0, array_sort({plain}), {alone})")


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``row`` (the columns of docs), ``base`` and ``linked``: arrays of (start, kind number, end)."""
    c = F.col
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 8
    base = docs.select(whole(docs).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    t = c("t")
    base = _with_found(base, "assign", ASSIGN, 0, t.rlike(ASSIGN), value)
    base = _with_found(base, "access", ACCESS, 1, t.contains("AKIA"))
    base = _with_found(base, "hex", HEX, 2, t.rlike(HEX))
    base = base.withColumns({"strong": F.concat("assign", "hex"), "base": F.concat("assign", "access", "hex"), "anchored": t.contains("://") | (F.size("access") > 0) | t.rlike(IDENTIFIER)})
    apart = lambda weak, other: _chosen(weak, other, -1, False)
    linked = lambda weak, other: _chosen(weak, other, reach, True)
    letters = lambda hit: hit.rlike("[A-Za-z]") & hit.rlike("[0-9]")
    base = _with_found(base, "runs", SECRET, 4, c("anchored"), letters).withColumn("runs", apart("runs", "base"))
    both = c("anchored") & ((F.size("strong") > 0) | (F.size("runs") > 0))
    base = _with_found(base, "names", IDENTIFIER, 3, both)
    base = _with_found(base, "hosts", ENDPOINT, 5, both & t.contains("://"))
    base = base.withColumns({"names": apart("names", "base"), "hosts": apart("hosts", "base")})
    # A bare run inside an identifier or endpoint is that part.
    base = base.withColumn("ends", F.concat("names", "hosts")).withColumn("runs", apart("runs", "ends"))
    base = base.withColumns({"secret_side": F.concat("strong", "runs"), "other_side": F.concat("access", "ends")})
    found = F.concat(linked("names", "secret_side"), linked("runs", "other_side"), linked("hosts", "secret_side"))
    return base.select("row", "base", found.alias("linked"))


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, counts by base kind, base_sha256, spans (text) and n_linked."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    found = scan(docs.select("doc_id", "text"), reach)
    return found.select("row.doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))


def redact(docs: DataFrame, reach: int = REACH, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span, merged where they overlap, replaced in ``text``; null text stays null, n_chars follows."""
    found = scan(docs, reach).select("row", F.array_sort(F.concat("base", "linked")).alias("spans"))
    text = F.col("row.text")
    # What stays before each span, and a mark where a span begins that no earlier one covers.
    quoted = mark.replace("\\", "\\\\").replace("'", "\\'")
    piece = lambda at, s: f"array(substr(row.text, {at} + 1, greatest({s}.start - {at}, 0)), if({s}.start >= {at}, '{quoted}', ''))"
    parts = F.expr(_gather("spans", "0", lambda at, s: f"greatest({at}, {s}.end)", piece, "array<string>"))
    end = F.expr("coalesce(array_max(transform(spans, s_ -> s_.end)), 0)")
    done = F.concat(F.array_join(parts, ""), text.substr(end + 1, F.length(text)))
    found = found.select("row", F.when(F.size("spans") > 0, done).otherwise(text).alias("clean"), (F.size("spans") > 0).alias("changed"))
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("changed"), F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("clean")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def _oracle(reach: int = REACH) -> str:
    """The same report in DuckDB SQL."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    either = {w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key", "client_id", "access_key_id", "account_id", "username", "user", "login")}
    assign = ASSIGN.replace("(?i:password|passwd|secret|token|api_?key)", "(?:" + "|".join(either[w] for w in ("password", "passwd", "secret", "token", "api_?key")) + ")")
    ident = IDENTIFIER.replace("(?i:client_id|access_key_id|account_id|username|user|login)", "(?:" + "|".join(either[w] for w in ("client_id", "access_key_id", "account_id", "username", "user", "login")) + ")")
    whole = assign.replace("([A-Za-z0-9+/_.=-]+)", "[A-Za-z0-9+/_.=-]+")

    def found(pattern: str, kind: int, keep: str) -> str:
        m, b = f"regexp_extract_all(t, {quote(pattern)})", f"string_split_regex(t, {quote(pattern)})"
        start = "(coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))"
        return f"(SELECT list({{'s': s, 'k': {kind}, 'e': s + length(hit)}} ORDER BY s) FROM (SELECT m[i] AS hit, {start}::INT AS s FROM (SELECT unnest(range(1, len(m) + 1)) AS i, m, b FROM (SELECT {m} AS m, {b} AS b)) ) WHERE {keep})"

    none = "[]::STRUCT(s INT, k INT, e INT)[]"
    cast = "::STRUCT(s INT, k INT, e INT)[]"
    apart = lambda a, b: f"list_filter({a}, lambda w: len(list_filter({b}, lambda o: w.s < o.e AND o.s < w.e)) = 0)"
    near = lambda a, b: f"list_filter({a}, lambda w: len(list_filter({b}, lambda o: w.s <= o.e + {reach} AND o.s <= w.e + {reach})) > 0)"
    kinds = "[" + ",".join(f"'{k}'" for k in KINDS) + "]"
    joined = lambda a: f"array_to_string(list_transform(list_sort({a}), lambda x: {kinds}[x.k + 1] || ':' || x.s || ':' || x.e), ',')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
base AS (SELECT rid, doc_id, t, coalesce({found(whole, 0, f"length(regexp_extract(hit, {quote(assign)}, 1)) >= 8")}{cast}, {none}) AS a,
  coalesce({found(ACCESS, 1, "true")}{cast}, {none}) AS c, coalesce({found(HEX, 2, "true")}{cast}, {none}) AS h FROM d),
weak AS (SELECT *, list_concat(list_concat(a, c), h) AS b, CASE WHEN contains(t, '://') OR len(c) > 0 OR regexp_matches(t, {quote(ident)}) THEN coalesce({found(SECRET, 4, "regexp_matches(hit, '[A-Za-z]') AND regexp_matches(hit, '[0-9]')")}{cast}, {none}) ELSE {none} END AS s0,
  coalesce({found(ident, 3, "true")}{cast}, {none}) AS i0, coalesce({found(ENDPOINT, 5, "true")}{cast}, {none}) AS e0 FROM base),
free AS (SELECT *, {apart("s0", "b")} AS s1, {apart("i0", "b")} AS i1, {apart("e0", "b")} AS e1 FROM weak),
parts AS (SELECT *, list_concat(i1, e1) AS ends, list_concat(a, h) AS strong, {apart("s1", "list_concat(i1, e1)")} AS s2 FROM free),
linked AS (SELECT *, list_concat(list_concat({near("i1", "list_concat(strong, s2)")}, {near("s2", "list_concat(c, ends)")}), {near("e1", "list_concat(strong, s2)")}) AS l FROM parts)
SELECT doc_id, len(a)::BIGINT AS n_assign, len(c)::BIGINT AS n_access, len(h)::BIGINT AS n_hex, sha256({joined("b")}) AS base_sha256, {joined("list_concat(b, l)")} AS spans, len(l)::BIGINT AS n_linked FROM linked
"""


ORACLE = _oracle()
