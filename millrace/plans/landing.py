"""Queries over sources and sinks: tables are written to the shared folder in a landed form, read again and compared with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import similarity as S
from ..operators import filings, lookup, ordered
from ..session import checkpoint_dir
from ..sources import captured, readers, sinks
from ..streaming import incremental, supervise
from . import duck as D
from . import enrich, providers
from .queries import _LINES, _LOOK, _REPS, _SCORED, _inputs, _n, _page, query, tbl
from .samples import LOC_SQL, REG_SQL, locations, registry_rows

c = F.col


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}/{name}"


# ---- text files ---------------------------------------------------------------


@query(f"SELECT brand, franchisee_name, raw_address, file || '.csv' AS file, (row_number() OVER (ORDER BY file, ord) - 1)::BIGINT AS n FROM (SELECT brand, franchisee_name, raw_address, replace(file, '_raw.csv', '') AS file, ord FROM {LOC_SQL})")
def sc_csv_files(spark, d):
    """SC4, SK1: several headed files, read in order of name and place, numbered through."""
    path = scratch(spark, "raw")
    rows = locations(spark, d).select("brand", _n, "raw_address", F.replace("file", F.lit("_raw.csv"), F.lit("")).alias("part"), "ord")
    for part in "abcde":  # one small file each, as such inputs come
        sinks.write_csv(rows.filter(c("part") == part).orderBy("ord").drop("part", "ord").coalesce(1), f"{path}/{part}")
    raw = readers.read_raw_records(spark, f"{path}/*").withColumn("brand_", F.col("brand"))
    first = raw.groupBy("file").agg(F.min("brand").alias("b"))
    names = {b: f"{p}.csv" for p, b in zip("abcde", ("Alpha Grill", "Beta Pizza", "Gamma Care", "Delta Diner", "Echo Subs"))}
    label = F.coalesce(*(F.when(c("b") == b, f) for b, f in names.items()))
    ranked = raw.join(first, "file").withColumn("file", label)
    # File names are the writer's; their order is by brand folder here, so the number is taken again by label.
    before = ranked.groupBy("file").agg(F.count("*").alias("m"), F.min("ord").alias("low"))
    starts = before.alias("x").join(before.alias("y"), c("y.file") < c("x.file"), "left").groupBy("x.file", "x.low").agg(F.coalesce(F.sum("y.m"), F.lit(0)).alias("start"))
    return ranked.join(starts, "file").select("brand", _n, "raw_address", "file", (c("ord") - c("low") + c("start")).alias("n"))


@query(f"SELECT rid::VARCHAR AS entity_id, firm AS current_name, status AS status_1 FROM {REG_SQL}")
def sc_registry_csv(spark, d):
    """SC5, SC10, SC11: a bulk file with a byte-order mark and odd headers."""
    path = scratch(spark, "registry")
    registry_rows(spark, d).select(c("rid").cast("string").alias("﻿Entity ID"), c("firm").alias("Current  Name:"), c("status").alias("(Status) #1")).write.option("header", True).csv(path)
    return readers.read_registry_csv(spark, path, "current_name").select("entity_id", "current_name", "status_1")


@query("SELECT 'there' AS kind, count(*) AS n FROM nation UNION ALL SELECT 'missing', 0")
def sc_maybe_missing(spark, d):
    """SC6: a table that may not be there yet has no rows."""
    path = scratch(spark, "master")
    sinks.write_csv(tbl(spark, d, "nation").select("n_nationkey", "n_name"), path)
    count = lambda p, kind: readers.read_if_there(spark, p, "n_nationkey int, n_name string").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(path, "there").unionByName(count(path + "-none", "missing"))


@query(f"SELECT brand, franchisee_name, ord FROM {LOC_SQL} WHERE file = 'b_raw.csv'")
def sc_brand_file(spark, d):
    """SC7: the first file whose first row is one of the brand's names; copies of originals do not count."""
    loc = locations(spark, d).select("brand", _n, "file", "ord")
    copies = loc.filter("file = 'b_raw.csv'").withColumn("file", F.lit("a_raw.original.csv"))
    return readers.brand_file(loc.unionByName(copies), ["beta pizza", "Beta"]).select("brand", _n, "ord")


@query("SELECT c_custkey AS k, c_name AS name, (c_custkey % 3 <> 0) AS good FROM customer WHERE c_custkey % 7 <> 0")
def sc_json_items(spark, d):
    """SC12, SC16, SK5: a cache written as JSON and read again; broken lines give no row."""
    path = scratch(spark, "cache")
    t = tbl(spark, d, "customer")
    line = F.to_json(F.struct(c("c_custkey").alias("k"), c("c_name").alias("name"), (c("c_custkey") % 3 != 0).alias("good")))
    t.select(F.when(c("c_custkey") % 7 == 0, F.concat(F.lit("{broken "), "c_name")).otherwise(line).alias("value")).write.text(path)
    return readers.read_items(spark, path, "k long, name string, good boolean").filter("k is not null")


@query("SELECT 1 AS documents, count(*) AS brands, min(p_brand) AS first_brand, max(p_brand) AS last_brand FROM (SELECT DISTINCT p_brand FROM part)")
def sk_catalogue(spark, d):
    """SK8, SC12: the catalogue as one JSON document, written and read again."""
    path = scratch(spark, "catalogue")
    brands = tbl(spark, d, "part").select(c("p_brand").alias("name"), F.array(F.lit("t")).alias("tags"), F.lit("seed").alias("source")).distinct()
    sinks.catalogue_json(brands, "2026-01-01").write.text(path)
    got = readers.read_json_cache(spark, path, "updated string, count int, brands array<struct<name:string,tags:array<string>,source:string>>")
    return got.select(F.lit(1).alias("documents"), c("count").cast("long").alias("brands"), c("brands")[0]["name"].alias("first_brand"), F.element_at("brands", -1)["name"].alias("last_brand"))


@query("SELECT n_nationkey::VARCHAR AS rid, n_name || ', R' || n_regionkey AS principal_address, CASE WHEN n_nationkey % 2 = 0 THEN 'mine' ELSE 'Good' END AS standing_sos FROM nation")
def j_drawer_backfill(spark, d):
    """SC13, J11: captured pages, a file each, fill the blank columns of the rows they belong to."""
    path = scratch(spark, "drawers")
    t = tbl(spark, d, "nation").select(c("n_nationkey").cast("string").alias("entity_number"), "n_name", "n_regionkey")
    text = F.concat(F.lit("Principal Address\t"), "n_name", F.lit("\nR"), "n_regionkey", F.lit("\nStanding - SOS\tGood\nHistory\nx"))
    for r in t.select("entity_number", text.alias("text")).collect():  # 25 rows, to make the files
        _land_bytes(spark, f"{path}/{r['entity_number']}.txt", r["text"].encode())
    parsed = readers.read_captured(spark, path).select("entity_number", *(v.alias(k) for k, v in captured.ca_drawer(c("text")).items()))
    rows = t.select("entity_number", F.lit(" ").alias("principal_address"), F.when(c("entity_number").cast("int") % 2 == 0, "mine").alias("standing_sos"))
    out = enrich.backfill_drawer(rows, parsed, ["principal_address", "standing_sos"])
    return out.select(c("entity_number").alias("rid"), "principal_address", "standing_sos")


@query("SELECT 'p' || o_orderkey AS path FROM orders WHERE datediff('day', o_orderdate::DATE, DATE '1998-08-02') > 90")
def sc_stale(spark, d):
    """SC18, DT5: files older than some days."""
    files = tbl(spark, d, "orders").select(F.concat(F.lit("p"), "o_orderkey").alias("path"), c("o_orderdate").cast("timestamp").alias("modificationTime"))
    return readers.stale(files, 90, "1998-08-02").select("path")


@query("SELECT 'K_' || c_custkey AS key, c_name AS value FROM customer WHERE c_custkey % 5 <> 0")
def sc_settings(spark, d):
    """SC20: settings out of K=V lines, comments left out."""
    v = F.when(c("c_custkey") % 2 == 0, F.concat(F.lit('"'), "c_name", F.lit('"'))).otherwise(c("c_name"))
    line = F.when(c("c_custkey") % 5 == 0, F.concat(F.lit("# K="), "c_name")).otherwise(F.concat(F.lit(" K_"), "c_custkey", F.lit(" = "), v, F.lit(" ")))
    return readers.settings(tbl(spark, d, "customer").select(line.alias("value")))


def _zipped(texts: list[str]) -> bytes:
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, t in enumerate(texts):
            z.writestr(zipfile.ZipInfo(f"part{i}.txt"), t)
        z.writestr(zipfile.ZipInfo("readme.md"), "not a shard")
    return out.getvalue()


def _land_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one file wherever Spark can write."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    out.write(content)
    out.close()


@query("SELECT 'part' || (n_nationkey % 3) || '.txt' AS member, count(*) AS lines, min(n_name) AS low, max(n_name) AS high FROM nation GROUP BY 1")
def sc_zip_shards(spark, d):
    """SC9: a zip of several text shards, a task each."""
    rows = sorted((r["n_nationkey"], r["n_name"]) for r in tbl(spark, d, "nation").collect())  # 25 rows, to make the file
    path = scratch(spark, "zip") + "/shards.zip"
    _land_bytes(spark, path, _zipped(["".join(f"{n}\n" for k, n in rows if k % 3 == i) for i in range(3)]))
    lines = readers.read_zip_lines(spark, path)
    return lines.groupBy("member").agg(F.count("*").alias("lines"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("SELECT r_name || '.pdf' AS doc_id, n.page::INT AS page_no, r_name || ' page ' || n.page AS text FROM region, (SELECT unnest([1, 2]) AS page) n WHERE r_regionkey <> 2")
def sc_pdf_pages(spark, d):
    """SC1, SC19: pages of documents by a given extractor; a file without the magic bytes gives none."""
    path = scratch(spark, "pdf")
    for r in tbl(spark, d, "region").collect():  # five rows, to make the files
        head = "<html>" if r["r_regionkey"] == 2 else "%PDF-"
        _land_bytes(spark, f"{path}/{r['r_name']}.pdf", f"{head}{r['r_name']} page 1|{r['r_name']} page 2".encode())
    return readers.pdf_pages(spark, path, lambda content: content.decode()[5:].split("|"))


# ---- sinks --------------------------------------------------------------------


@query(f"SELECT brand, count(*) AS n, min(ord) AS low FROM (SELECT * FROM {LOC_SQL} UNION ALL SELECT * FROM {LOC_SQL} WHERE ord % 10 = 0) GROUP BY brand")
def sk_append(spark, d):
    """SK2: records appended, a folder for each brand."""
    path = scratch(spark, "brands")
    loc = locations(spark, d).select("brand", _n, "ord")
    sinks.append_brand(loc, path)
    sinks.append_brand(loc.filter("ord % 10 = 0"), path)
    return spark.read.parquet(path).groupBy("brand").agg(F.count("*").alias("n"), F.min("ord").alias("low"))


@query(f"SELECT ord, 'new ' || city AS city, franchisee_name FROM {LOC_SQL} WHERE ord % 2 = 0 UNION ALL SELECT ord, NULL, franchisee_name FROM {LOC_SQL} WHERE ord % 2 = 1")
def sk_merge_right(spark, d):
    """SK4: a row and its result merged; the result's value wins."""
    loc = locations(spark, d).select("ord", "city", _n)
    return sinks.merge_right(loc, loc.filter("ord % 2 = 0").select("ord", F.concat(F.lit("new "), "city").alias("city")), "ord").select("ord", "city", _n)


@query(f"WITH k AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(brand)), lower(trim(franchisee_name)), lower(trim(raw_address)), lower(trim(city)), lower(trim(zip)) ORDER BY ord) AS rn FROM {LOC_SQL}) SELECT 'v1' AS version, count(*) AS n FROM (SELECT DISTINCT lower(trim(brand)), lower(trim(franchisee_name)), lower(trim(raw_address)), lower(trim(city)), lower(trim(zip)) FROM {LOC_SQL} WHERE ord % 2 = 0) UNION ALL SELECT 'v2', count(*) FROM k WHERE rn = 1")
def sk_versions(spark, d):
    """SK3, SK6: each merge writes a new version and leaves the one before as the backup."""
    path = scratch(spark, "table")
    loc = locations(spark, d)
    sinks.upsert(spark, loc.filter("ord % 2 = 0"), path, "v1")
    sinks.upsert(spark, loc.filter("ord % 2 = 1"), path, "v2")
    n = lambda v: sinks.read_version(spark, path, v).agg(F.count("*").alias("n")).select(F.lit(v).alias("version"), "n")
    return n("v1").unionByName(n("v2"))


@query(f"SELECT franchisee_name, raw_address, min(ord) AS ord FROM (SELECT lower(trim(franchisee_name)) AS franchisee_name, lower(trim(raw_address)) AS raw_address, ord FROM {LOC_SQL}) GROUP BY 1, 2")
def sr_overlap(spark, d):
    """SR3, SO3: files that arrive as a stream, with overlaps; the first of each key stays."""
    inbox, table, marks = (scratch(spark, x) for x in ("inbox", "table", "marks"))
    loc = locations(spark, d).select("ord", "brand", _n, "raw_address", "city", "zip").withColumns({"brand": F.lit("b"), "city": F.lit("c"), "zip": F.lit("z")})
    loc.unionByName(loc.filter("ord % 4 = 0")).write.parquet(inbox)
    incremental.ingest(incremental.new_records(spark, inbox, loc.schema.simpleString()[7:-1].replace(":", " "), "parquet"), table, marks).awaitTermination()
    return sinks.read_version(spark, table).select(F.lower(F.trim(_n)).alias(_n), F.lower(F.trim("raw_address")).alias("raw_address"), "ord")


@query("SELECT source, count(*) AS total, count(*) FILTER (doc_id % 3 = 0) AS finished, round(count(*) FILTER (doc_id % 3 = 0) / count(*), 4) AS share FROM documents GROUP BY source")
def sr_progress(spark, d):
    """SR5, SR6: a supervised run that breaks twice, and how far each group is."""
    docs = tbl(spark, d, "documents").select("doc_id", "source")
    path, tries = scratch(spark, "done"), iter((0, 1, 2))

    def run() -> bool:
        part = next(tries)
        docs.filter((c("doc_id") % 9 == 3 * part)).write.mode("append").parquet(path)
        if part < 2:
            raise RuntimeError("usage limit" if part else "lost")
        return True

    supervise.until_done(run, sleep=lambda s: None)
    return supervise.progress_view(docs, spark.read.parquet(path), "source")


# ---- scores, ladders, providers -------------------------------------------------

_ASKED = "CASE rid % 4 WHEN 0 THEN firm || ' of Texas' WHEN 1 THEN string_split(firm, ' ')[1] || ' Foods' WHEN 2 THEN 'Northern ' || firm ELSE firm END"
_SIM = D.jaccard(D.similar("ask"), D.similar("firm"))
_REC = "CASE WHEN iso LIKE '____-__-__' THEN (iso::DATE - DATE '2000-01-01') * 0.001 ELSE 0.0 END"
_HINT = {s: D.q(N.OUT_OF_STATE[s].replace("(?U)", "")) for s in N.OUT_OF_STATE}
_out = lambda test, s: f"CASE WHEN ({test}) AND NOT regexp_matches(ask, {_HINT[s]}) THEN -30.0 ELSE 0.0 END"


@query(
    f"""WITH t AS (SELECT *, {_ASKED} AS ask, lower(jurisdiction) AS j, CASE rid % 6 WHEN 0 THEN 'Active' WHEN 1 THEN 'Suspended - FTB' WHEN 2 THEN 'Forfeited' WHEN 3 THEN 'Merged Out' WHEN 4 THEN 'Inactive' ELSE 'Pending' END AS s FROM {REG_SQL}), u AS (SELECT *, {_SIM} AS sim FROM t)
SELECT rid, round(CASE s WHEN 'Active' THEN 100.0 WHEN 'Inactive' THEN 100.0 WHEN 'Suspended - FTB' THEN 20.0 WHEN 'Forfeited' THEN -50.0 WHEN 'Merged Out' THEN -100.0 ELSE 0.0 END + sim * 100 + {_out("j <> '' AND NOT contains(j, 'california')", "ca")} + CASE WHEN iso LIKE '____-__-__' THEN (iso::DATE - DATE '2000-01-01') * 0.001 ELSE 0.0 END, 6) AS ca,
round(CASE WHEN flag = 'A' THEN 100.0 ELSE -50.0 END + sim * 100 + {_out("filing LIKE 'FOR%'", "fl")}, 6) AS fl,
round(100.0 + sim * 100 + {_out("j <> '' AND NOT contains(j, 'new york')", "ny")} + {_REC}, 6) AS ny, round(50.0 + sim * 100, 6) AS tx, round_even(50.0 + sim * 100, 2) AS shown FROM u"""
)
def sm_scores(spark, d):
    """SM7, SM8, SM9, SM11, ST17, SO4, MA2: the scores of every record for a name like its own."""
    r = registry_rows(spark, d)
    ask = F.expr("CASE rid % 4 WHEN 0 THEN concat(firm, ' of Texas') WHEN 1 THEN concat(split(firm, ' ')[0], ' Foods') WHEN 2 THEN concat('Northern ', firm) ELSE firm END")
    s = F.expr("CASE rid % 6 WHEN 0 THEN 'Active' WHEN 1 THEN 'Suspended - FTB' WHEN 2 THEN 'Forfeited' WHEN 3 THEN 'Merged Out' WHEN 4 THEN 'Inactive' ELSE 'Pending' END")
    from ..operators.derive import us_date

    t = r.select("*", ask.alias("ask"), s.alias("s"))
    status = F.when(c("flag") == "A", "Active").otherwise("Inactive")
    six = lambda x: F.round(x, 6)
    return t.select("rid", six(S.score_ca(c("ask"), c("firm"), c("s"), F.lit(""), c("jurisdiction"), us_date(c("iso")))).alias("ca"), six(S.score_fl(c("ask"), c("firm"), status, c("filing"))).alias("fl"), six(S.score_ny(c("ask"), c("firm"), c("jurisdiction"), c("iso"))).alias("ny"), six(S.score_tx(c("ask"), c("firm"))).alias("tx"), F.bround(S.score_tx(c("ask"), c("firm")), 2).alias("shown"))


@query(
    f"""WITH t AS (SELECT rid, CASE rid % 3 WHEN 0 THEN lower(firm) WHEN 1 THEN string_split(firm, ' ')[1] ELSE firm END AS requested, CASE WHEN rid % 5 = 0 THEN '~~~~' ELSE firm END AS name, CASE rid % 4 WHEN 0 THEN 'Final FDD' WHEN 1 THEN 'Clean FDD' ELSE 'Letter' END AS kind FROM {REG_SQL}),
s AS (SELECT *, CASE WHEN name = '~~~~' THEN 0.0 WHEN lower(requested) = lower(name) THEN 1.0 ELSE 0.9 END AS score FROM t)
SELECT requested, rid, score::DOUBLE AS score FROM (SELECT *, row_number() OVER (PARTITION BY requested ORDER BY score DESC, CASE kind WHEN 'Clean FDD' THEN 1 WHEN 'Final FDD' THEN 2 ELSE 99 END, rid) AS rn FROM s WHERE score >= 0.25) WHERE rn = 1"""
)
def sm_direct(spark, d):
    """SM6, PF15: direct name scores with their floor; equal, contained and foreign names."""
    r = registry_rows(spark, d)
    asked = F.expr("CASE rid % 3 WHEN 0 THEN lower(firm) WHEN 1 THEN split(firm, ' ')[0] ELSE firm END")
    kind = F.expr("CASE rid % 4 WHEN 0 THEN 'Final FDD' WHEN 1 THEN 'Clean FDD' ELSE 'Letter' END")
    rows = r.select(asked.alias("requested"), F.when(c("rid") % 5 == 0, "~~~~").otherwise(c("firm")).alias("name"), kind.alias("documentType"), c("rid").alias("ord"))
    return filings.pick_direct(rows).select("requested", c("ord").alias("rid"), "score")


@query(f"WITH {_LOOK}, m AS (SELECT l.entity_name, count(*) AS n FROM (SELECT *, {D.similar('firm')} AS norm FROM {REG_SQL}) r JOIN look l USING (norm) GROUP BY 1) SELECT i.ord, i.franchisee_name AS entity_name, i.ord % 3 = 0 AS person, CASE WHEN i.ord % 3 = 0 THEN 0 ELSE coalesce(m.n, 0) END AS match_count FROM {LOC_SQL} i LEFT JOIN m ON m.entity_name = i.franchisee_name")
def pf_persons(spark, d):
    """PF9, J2: persons are not looked up and get a stub row."""
    inputs = _inputs(spark, d)
    typed = inputs.withColumn("entity_type", F.when(c("ord") % 3 == 0, "Person").otherwise("company"))
    asked, persons = enrich.without_persons(typed)
    m = lookup.match_all(inputs, registry_rows(spark, d), c("firm")).groupBy("entity_name").agg(F.count("*").alias("match_count"))
    done = lookup.complete(asked, m).select("ord", "entity_name", F.lit(False).alias("person"), "match_count")
    return done.unionByName(persons.select("ord", "entity_name", F.lit(True).alias("person"), F.lit(0).cast("long").alias("match_count")))


@query(
    f"""WITH ladder AS (SELECT ord, entity_name, unnest(list_concat([entity_name], {D.variants('entity_name')})) AS query, unnest(range(0, 1 + len({D.variants('entity_name')}))) AS rank FROM (SELECT ord, franchisee_name AS entity_name FROM {LOC_SQL})),
hit AS (SELECT ord, min(rank) AS at FROM ladder WHERE length(query) % 4 = 1 GROUP BY ord)
SELECT l.ord, coalesce(max(CASE WHEN l.rank = h.at THEN l.query END), '') AS query, string_agg(l.query, ' | ' ORDER BY l.rank) FILTER (h.at IS NULL OR l.rank <= h.at) AS attempts FROM ladder l LEFT JOIN hit h USING (ord) GROUP BY l.ord"""
)
def dv_ladder(spark, d):
    """DV10: the first query of a name's ladder that finds something, and what was tried."""
    inputs = _inputs(spark, d).select("ord", "entity_name")
    tried = inputs.select(F.explode(F.concat(F.array("entity_name"), N.name_variants(c("entity_name")))).alias("query")).distinct()
    out = lookup.first_variant(inputs.select("ord", F.concat_ws("", "entity_name").alias("entity_name")), tried.filter(F.length("query") % 4 == 1), keep_ord=True)
    return out.select("ord", "query", "attempts")


@query(
    f"""SELECT rid, CASE WHEN officer <> '' AND officer NOT LIKE '%LLC%' THEN 'True' WHEN officer = '' THEN 'False' ELSE 'False' END AS individual,
CASE WHEN officer <> '' THEN officer ELSE 'NONE INC' END AS agent_name FROM {REG_SQL}"""
)
def dv_rescore(spark, d):
    """DV7, DV9: derived columns computed again from the kept ones, without matching."""
    pages = _page(registry_rows(spark, d))
    kept = pages.select("rid", *(v.alias(k) for k, v in captured.tx_detail(c("text")).items())).withColumns({"principal_address": F.lit(""), "agent_is_individual": F.lit("stale"), "likely_owner_name": F.lit("stale")})
    return enrich.rescore(kept, "tx").select("rid", c("agent_is_individual").alias("individual"), "agent_name")


@query(f"WITH {_SCORED} SELECT scope, count(*) AS pairs, count(*) FILTER (score >= 90) AS yes, count(*) FILTER (score >= 96) AS auto FROM scored GROUP BY scope")
def er_provider(spark, d):
    """ER7, ER8: open pairs handed to a provider, its answers kept and used."""
    from ..operators import resolution

    pairs = resolution.candidate_pairs(resolution.representatives(locations(spark, d)))
    none = spark.createDataFrame([], "pair_key string, match boolean, confidence int")
    table = providers.settle(pairs, none, providers.ThresholdDecisions(90))
    routed = resolution.cascade(pairs, table)
    return routed.groupBy("scope").agg(F.count("*").alias("pairs"), F.count_if("accepted").alias("yes"), F.count_if(c("route") == "auto").alias("auto"))


@query(
    f"""WITH {_LINES}, cover AS (SELECT DISTINCT doc_id, lower(text) AS t FROM lines WHERE line_no < 3), b AS (SELECT unnest(['ation', 'ing', 'the ']) AS name), f AS (SELECT doc_id, min(name) AS name FROM cover JOIN b ON contains(t, name) GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN 'Said' ELSE f.name END AS brand, d.doc_id % 5 <> 1 AS holds FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN f USING (doc_id)"""
)
def dv_cover_brand(spark, d):
    """DV14: brand by verdict or by the cover's lines; sections hold unless a verdict says no."""
    docs = tbl(spark, d, "documents")
    lines = ordered.lines_of(docs)
    said = docs.select("doc_id", F.when(c("doc_id") % 4 == 0, "Said").otherwise("").alias("brand"))
    brands = spark.createDataFrame([("ation",), ("ing",), ("the ",)], "name string")
    answers = docs.select("doc_id", F.expr("CASE doc_id % 5 WHEN 1 THEN ' NO' WHEN 2 THEN 'yes' ELSE 'perhaps' END").alias("answer")).filter("doc_id % 5 <> 3")
    return ordered.section_holds(ordered.cover_brand(lines, said, brands, 3), answers).select("doc_id", "brand", "holds")


@query("SELECT c_custkey AS k, '2026-01-02T03:04:05+00:00' AS fetched_at, true AS recent FROM customer")
def dt_now(spark, d):
    """DT4: when a row was fetched: given, or the query's own time."""
    t = tbl(spark, d, "customer").select(c("c_custkey").alias("k"), F.lit("2026-01-02T03:04:05+00:00").alias("fetched_at"))
    return t.select("k", "fetched_at", enrich.utc_now().rlike(r"^20\d\d-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$").alias("recent"))
