"""The command line and landed files, end to end on small invented inputs."""

import pytest

from millrace.__main__ import main
from millrace.plans.providers import TableDecisions, ThresholdDecisions, settle
from millrace.operators.resolution import candidate_pairs, cascade, representatives
from millrace.sources import readers
from tests.test_operators import COLUMNS, RAW


def rows_of(spark, path):
    return [r.asDict() for r in readers.read_registry_csv(spark, str(path)).collect()]


def test_directory_commands(spark, tmp_path):
    head = "brand,franchisee_name,raw_address,city,state,zip,restaurant_phone\n"
    lines = [f'Alpha Grill,"Example Foods, Llc",{i} Test St,Springfield,TX,75001,\n' for i in range(6)] + ["Alpha Grill,Pat Doe,9 Test St,Ogden,UT,84401,\n"]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "alpha_raw.csv").write_text(head + "".join(lines))
    main(["match", str(tmp_path / "raw"), str(tmp_path / "ops")])
    ops = rows_of(spark, tmp_path / "ops")
    assert [(o["franchisee_name"], o["total_units"]) for o in ops] == [("Example Foods, Llc", "6"), ("Pat Doe", "1")]
    main(["filter", str(tmp_path / "ops"), str(tmp_path / "icp")])
    assert [(r["franchisee_name"], r["tier"]) for r in rows_of(spark, tmp_path / "icp")] == [("Example Foods, Llc", "B")]
    main(["classify", str(tmp_path / "ops"), str(tmp_path / "cls")])
    assert {r["franchisee_name"]: r["entity_type"] for r in rows_of(spark, tmp_path / "cls")} == {"Example Foods, Llc": "company", "Pat Doe": "person"}


def test_enrich_command(spark, tmp_path):
    (tmp_path / "in.csv").write_text('entity_name\n"Example Foods, Llc"\nNobody Inc\n')
    head = "Entity ID,entityname,entitystatus,entitytype,entityformdate,jurisdictonofformation,agentfirstname,agentmiddlename,agentlastname,agentsuffix,agentorganizationname"
    places = ",".join(p + n for p in ("agentprincipal", "principal", "mailing") for n in ("address1", "address2", "city", "state", "zipcode"))
    row = '1,"EXAMPLE FOODS, LLC, Delinquent May 1, 2016",Good Standing,DLLC,2001-02-03,CO,PAT,,DOE,,,' + ",".join(["1 Main Street", "", "Ogden", "UT", "84401"] * 3)
    (tmp_path / "reg.csv").write_text(f"{head.replace('Entity ID', 'entityid')},{places}\n{row}\n{row.replace('1,', '2,', 1).replace('Good Standing', 'Expired')}\n")
    main(["enrich", str(tmp_path / "in.csv"), str(tmp_path / "out"), "--state", "co", "--registry", str(tmp_path / "reg.csv")])
    got = {r["entity_name"]: r for r in rows_of(spark, tmp_path / "out")}
    best = got["Example Foods, Llc"]
    assert (best["co_entity_number"], best["co_match_count"], best["co_likely_owner_name"], best["co_operator_pattern"], best["co_formation_date"]) == ("1", "2", "PAT DOE", "owner_operator", "02/03/2001")
    assert '"num":"2"' in best["co_alternates"] and got["Nobody Inc"]["co_match_count"] == "0"


def test_providers(spark):
    pairs = candidate_pairs(representatives(spark.createDataFrame(RAW, COLUMNS)), same=40, cross=40)
    none = spark.createDataFrame([], "pair_key string, match boolean, confidence int")
    table = settle(pairs, none, ThresholdDecisions(50))
    assert cascade(pairs, table).filter("route in ('cheap', 'strong')").count() == 0
    again = settle(pairs, none, TableDecisions(table))
    assert again.count() == table.count()


def test_landed_files(spark, tmp_path):
    (tmp_path / "123.txt").write_text("Agent\tx\n")
    assert [tuple(r) for r in readers.read_captured(spark, f"{tmp_path}/123.txt").collect()] == [("123", "Agent\tx\n")]
    (tmp_path / "items.json").write_text('{"a": 1}\nbroken\n')
    assert [r["a"] for r in readers.read_items(spark, f"{tmp_path}/items.json", "a int").collect()] == [1]
    lines = spark.createDataFrame([("A=1",), ("# c",), ('B_2 = "x y"',)], "value string")
    assert {r["key"]: r["value"] for r in readers.settings(lines).collect()} == {"A": "1", "B_2": "x y"}
    files = spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("b", "2026-03-01 00:00:00")], "path string, t string").selectExpr("path", "cast(t as timestamp) as modificationTime")
    assert [r["path"] for r in readers.stale(files, 30, "2026-03-05").collect()] == ["a"]


def test_missing_column(tmp_path, spark):
    (tmp_path / "bad.csv").write_text("x\n1\n")
    with pytest.raises(ValueError, match="entity_name"):
        main(["enrich", str(tmp_path / "bad.csv"), str(tmp_path / "o"), "--state", "co", "--registry", "r"])
