"""Column functions on the documented fixtures."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import json as J
from millrace.functions import names as N
from millrace.functions import similarity as S


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_normalize_name(spark):
    names = ["john  smith JR", "X QSR", "aloha hawaii", "mcdonald's", "a-b c", " éCOLE d'été ", None, "Foo, III"]
    assert values(spark, names, N.normalize_name) == ["John Smith", "X Q", "Aloha Hawa", "Mcdonald'S", "A-B C", "École D'Été", "", "Foo"]
    assert values(spark, ["X QSR", "john smith jr."], lambda c: N.normalize_name(c, strict=True)) == ["X Qsr", "John Smith"]
    assert values(spark, ["  Foo,  Bar,", "Baz**", "Q *"], N.normalize_name_senior) == ["Foo, Bar", "Baz", "Q"]


def test_similarity_form(spark):
    names = ["Acme Foods, L.L.C.", "A & B Co.", "Ümlaut Ltd (Pat)", "Foo LP", None]
    assert values(spark, names, N.normalize_for_similarity) == ["acme foods", "a and b", "ümlaut", "foo lp", ""]


def test_variants(spark):
    assert values(spark, ["Acme Foods Holdings, LLC (Pat Doe)", "Bob", "", None, "Acme Inc"], N.name_variants) == [
        ["Acme Foods Holdings, LLC", "Acme Foods Holdings", "acme foods"], [], [], [], ["Acme"],
    ]


def test_address(spark):
    assert values(spark, ["12 Main Street, Suite 4, FL 33101", None], N.normalize_address) == ["12 main 4 33101", ""]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("", ("company", "")), ("Example Foods, Llc", ("company", "Example Foods, Llc")), ("Sample Llc (Pat Doe)", ("company_with_owner", "Pat Doe")), ("Sample Llc (Dba Other)", ("company", "Sample Llc")),
        ("Pat Doe (2)", ("person", "Pat Doe")), ("Pat A. Doe", ("person", "Pat A. Doe")), ("Doe, Pat A.", None), ("Anna De La Cruz", None), ("Test Hospitality", ("company", "Test Hospitality")),
    ],
)
def test_classify(spark, name, want):
    got = values(spark, [name], N.classify)[0]
    assert (tuple(got) if got else None) == want


def test_phone_and_lists(spark):
    assert values(spark, ["(555) 010-0001", "555/010-0002", "15550100003", " 12 ", None], N.format_phone) == ["(555) 010-0001", "(555) 010-0002", "(555) 010-0003", "12", ""]
    assert values(spark, ["a, B\nb,, A ,c"], N.parse_names) == [["a", "B", "c"]]
    assert [tuple(v) if v else None for v in values(spark, [" 3 - 7 ", "3–9", "x"], N.page_range)] == [(3, 7), (3, 9), None]
    assert values(spark, ["Pat 75001 (555) 010-0001 555-010-0002 84401-1234"], N.page_score) == [6]
    assert values(spark, ["Vietnamese Inc", "Ok Foods", "ab", None], N.valid_record_name) == [False, True, False, False]


def test_owner_key(spark):
    assert values(spark, ["Rock Llc (Drew Smith)", "Jason Patel", "Acme Foods", "Solo", "X Inc (One)", None], N.owner_key) == ["drew smith", "jason patel", None, None, None, None]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_ratios():
    import random

    rng = random.Random(0)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert S.lcs(a, b) == slow_lcs(a, b)
    assert S.token_sort("fuzzy wuzzy was a bear", "was a bear wuzzy fuzzy") == 100
    assert S.token_set("Tri-Arc Food Systems", "Tri-Arc Food Systems Tommy Haddock") == 100
    assert S.token_sort("", "a") == 0 and S.token_set(None, "a") == 0
    assert S.contained("foo", "the FOO shop") == 1.0 and S.contained("foo", "the FOO shop", 0.9) == 0.9 and S.contained("a", "") == 0.0


def test_jaccard(spark):
    df = spark.createDataFrame([("Acme Foods LLC", "ACME FOODS & GRILL"), ("", "x"), ("a b", "a b")], "a string, b string")
    assert [round(r[0], 3) for r in df.select(S.name_similarity(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 1.0]


def test_scores(spark):
    df = spark.createDataFrame([("Acme", "ACME LLC", "Noncompliant", "FLLC", "2000-01-11"), ("Texas Acme", "Acme", "Good Standing", "FPC", "bad")], "n string, f string, s string, t string, d string")
    got = [r[0] for r in df.select(S.score_co(F.col("n"), F.col("f"), F.col("s"), F.col("t"), F.col("d"))).collect()]
    assert got == pytest.approx([80 + 100 - 30 + 0.01, 100 + 50])


def test_json(spark):
    rows = ['```json\n{"a": 1}\n```', 'x {"a": 2} y', "none", '[{"a": 3}]', None]
    assert [v["a"] if v else None for v in values(spark, rows, lambda c: J.safe_json(c, "a int"))][:3] == [1, 2, None]
    got = values(spark, ['{"entity_type": "PERSON", "search_target": "P"}', "bad", '{"entity_type": "robot"}'], lambda c: J.entity_answer(c, F.lit("N")))
    assert [tuple(g) for g in got] == [("person", "P"), ("company", "N"), ("company", "N")]
