"""Supervision of a run, cover brands and zip shards on small inputs."""

import zipfile

import pytest

from millrace.operators import ordered
from millrace.sources import readers
from millrace.streaming import supervise


def test_waits_and_ends():
    waits, left = [], [RuntimeError("Usage Limit reached"), RuntimeError("lost"), False, True]

    def run():
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert supervise.until_done(run, sleep=waits.append) == 4 and waits == [600, 120, 120]
    with pytest.raises(TimeoutError, match="2 attempts"):
        supervise.until_done(lambda: False, attempts=2, sleep=lambda s: None)
    with pytest.raises(TimeoutError, match="1 attempts"):
        supervise.until_done(lambda: False, wall=100, sleep=lambda s: None, clock=lambda: 0.0)


def test_cover_brand(spark):
    lines = ordered.lines_of(spark.createDataFrame([(1, "x\nAcme Grill inc"), (2, "none"), (3, "Acme")], "doc_id long, text string"))
    brands = spark.createDataFrame([("Acme",), ("Acme Grill",)], "name string")
    said = spark.createDataFrame([(3, "Zed")], "doc_id long, brand string")
    assert {r["doc_id"]: r["brand"] for r in ordered.cover_brand(lines, said, brands).collect()} == {1: "Acme", 2: None, 3: "Zed"}


def test_zip_lines_in_pieces(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("b.txt", "é1\n2\r\n3".encode("latin-1"))
        z.writestr("a.txt", "")
        z.writestr("c.md", "no")
    got = sorted((r["member"], r["line_no"], r["value"]) for r in readers.read_zip_lines(spark, str(tmp_path), rows=2).collect())
    assert got == [("b.txt", 0, "é1"), ("b.txt", 1, "2"), ("b.txt", 2, "3")]
