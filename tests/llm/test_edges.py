"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns."""

import pytest

from millrace.llm import ann, attribution, langid, mixing, packing, quality, secrets, sharding, similar, simhash, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, k_ string, fp string, size string, cell string"
X = ("x", "x", "x", "x", "x")
LONG = "long words here again " * 60_000
ROWS = [
    (1, None, None, None, None, *X),
    (2, "", "en", "a", 0, *X),
    (3, "   \n\t ", "en", "a", 6, *X),
    (4, "Hello world, this is a plain text of some words.", "en", "a", 48, *X),
    (4, "Hello world, this is a plain text of some words.", "en", "a", 48, *X),
    (None, "No id but a text.", "fr", None, 17, *X),
    (None, None, None, None, None, *X),
    (5, "12345 67890 !!", None, "b", 14, *X),
    (6, LONG, "en", "b", len(LONG), *X),
    (7, "ünïcödé 🙂 ñandú", "es", "b", 15, *X),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 0, None), (3, 0, 1), (4, 1, 0), (4, None, 0), (None, 1, 0), (6, 1, 0), (7, 1, None)], "doc_id long, quality int, toxic int")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["langid", "simhash", "secrets", "mixing", "tokens", "sharding", "packing", "quality"])
def test_rows_and_empty_table(spark, docs, labels, name):
    run = {
        "langid": langid.identify,
        "simhash": simhash.near_duplicates,
        "secrets": secrets.report,
        "mixing": mixing.systematic_copies,
        "tokens": attribution.token_counts,
        "sharding": sharding.feistel_shards,
        "packing": packing.best_fit_packing,
        "quality": lambda d: quality.classify(d, labels),
    }[name]
    got = by_id(run(docs))
    ids = sorted(str(r[0]) for r in ROWS)
    if name in ("tokens", "packing"):
        assert {x[0] for x in got} == {r[0] for r in ROWS}
    else:
        position = run(docs).columns.index("doc_id")
        assert sorted(str(x[position]) for x in got) == ids
    assert by_id(run(docs)) == got  # reruns agree
    assert run(docs.limit(0)).count() == 0


def test_langid_undetermined(docs):
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs).collect() if r["lang_pred"] == "und"}
    assert got == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "und", 0.0), (5, "und", 0.0)}


def test_fingerprint_zero_links_like_any_other(docs):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect() if r["fp"] == 0}
    assert got == {(1, 1), (2, 1), (3, 1), (None, 1)}


CLASH = ("k_", "n_", "t_", "s_", "h", "h_", "score_", "copy_", "copies_", "text2_", "assign_", "row", "key", "base", "size", "cell", "rank", "r", "name", "clean", "spans", "base_spans_")


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "secrets", "mixing"])
def test_stages_keep_values(spark, docs, labels, name):
    """Columns of the user's come back with their values, whatever they are called."""
    from pyspark.sql import functions as F

    stage = {"quality": lambda d: quality.keep_good(d, labels, 0.0), "near_duplicates": similar.keep_one, "secrets": secrets.redact, "mixing": mixing.mix}[name]
    own = docs.select("doc_id", "text", "lang", "source", "n_chars", F.create_map(F.lit("a"), "lang").alias("map"), *(F.concat(F.lit(c + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASH))
    out = stage(own)
    assert out.columns == own.columns
    rows = out.collect()
    assert rows
    text = {r[0]: r[1] for r in ROWS}
    for r in rows:
        i = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert all(r[c] == f"{c}:{i}" for c in CLASH) and r["map"] == {"a": r["lang"]}
        assert r["doc_id"] is None or r["text"] == text[r["doc_id"]]
    want = {"quality": len(ROWS), "secrets": len(ROWS), "near_duplicates": 6}
    assert len(rows) == want.get(name, len(rows))
    assert stage(own.limit(0)).count() == 0


def test_repeated_rows_stay_apart_where_another_column_differs(spark):
    docs = spark.createDataFrame([(1, "same words here", "a", k % 2) for k in range(40)], "doc_id long, text string, source string, extra int")
    got = mixing.mix(docs).groupBy("extra").count().collect()
    assert {r["extra"]: r["count"] for r in got} == {0: 20, 1: 20}
    assert similar.keep_one(docs).count() == 1


def test_packing_of_any_id_and_any_bytes(spark):
    df = spark.createDataFrame([("a", b"plain text"), ("b", b"bad \xff\xfe bytes, \xc3("), (None, b"x")], "doc_id string, b binary").selectExpr("doc_id", "cast(b as string) as text")
    got = packing.best_fit_packing(df).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["None", "a", "b"] and {r["sequence_id"] for r in got} == {0}
    counts = {r["doc_id"]: r["doc_tokens"] for r in attribution.token_counts(df).collect()}
    assert counts["b"] > 3


def test_quality_of_one_class_and_of_no_label(spark, docs):
    one = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.classify(docs, one).collect()} == {1.0}
    assert {r["score"] for r in quality.classify(docs, one.limit(0)).collect()} == {0.5}


VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, n string"
VROWS = [
    (0, [1.0, 0.0, 0.0], 1, "x", "x", "x"),
    (1, [1.0, 0.0, 0.0], 1, "x", "x", "x"),
    (2, [1.0, 0.1, 0.0], 1, "x", "x", "x"),
    (3, [1.0, 0.1, 0.0], 2, "x", "x", "x"),
    (4, [0.0, 0.0, 0.0], 1, "x", "x", "x"),
    (5, None, 1, "x", "x", "x"),
    (6, [1.0, None, 0.0], 1, "x", "x", "x"),
    (7, [1.0, float("nan"), 0.0], 1, "x", "x", "x"),
    (8, [1.0, float("inf"), 0.0], 1, "x", "x", "x"),
    (9, [1.0, 0.0, 0.0], None, "x", "x", "x"),
    (10, [0.0, 1.0, 0.0], 1, "x", "x", "x"),
    (11, [0.0, 1.0], 1, "x", "x", "x"),
    (None, [0.0, 1.0, 0.0], 1, "x", "x", "x"),
    (10, [0.0, 1.0, 0.0], 1, "x", "x", "x"),
]


def test_vector_edges(spark):
    v = spark.createDataFrame(VROWS, VECTORS)
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_duplicates(v).collect()}
    assert got[0] == (2, 0, True) and got[1] == (2, 0, False) and got[2] == (2, 0, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11))
    assert got[None] == (0, None, True)
    assert vectors.near_duplicates(v).count() == len(VROWS)
    assert vectors.near_duplicates(v.limit(0)).count() == 0
    found = [tuple(r) for r in ann.nearest_neighbours(v, v.filter("vec_id = 0")).orderBy("rank").collect()]
    assert [(x[1], x[2]) for x in found] == [(1, 1), (2, 9), (3, 2), (4, 3), (5, 10)]
    assert ann.nearest_neighbours(v.limit(0), v.limit(0)).count() == 0
