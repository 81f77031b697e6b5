"""Directory-shaped tables made from the star-schema test tables, by expressions that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

STEMS = ("Acme", "Bluebird", "Cedar Point", "Dunmore", "Elkhorn", "Foxglove", "Granite", "Harbor", "Ironwood", "Juniper", "Kestrel", "Lakeside", "Maple", "Northern Oak", "Orchard", "Pioneer", "Quarry", "Redstone", "Summit", "Tamarack", "Upland", "Valley", "Willow")


def pick(number: str, values: tuple[str, ...]) -> str:
    """SQL: the value at number modulo their count."""
    if not any(v.startswith("(") for v in values):
        return f"split_part('{'|'.join(values)}', '|', CAST(({number}) % {len(values)} AS INT) + 1)"
    quoted = [v if v.startswith("(") and v.endswith(")") else "'" + v.replace("'", "''") + "'" for v in values]
    return f"CASE ({number}) % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(quoted)) + " END"


def _name(k: str) -> str:
    s = f"({pick(f'{k} * 5', STEMS)})"
    return pick(
        f"{k} * 31 + 7",
        (
            f"({s} || ' Foods, Llc')", f"({s} || ' Holdings Inc.')", f"({s} || ' Restaurants')", f"({s} || ' Group (Pat Doe)')", f"('Pat ' || {s})", f"({s} || ', Pat A.')",
            f"({s} || ' Hospitality (2)')", f"(upper({s}) || ' FOODS, LLC')", f"({s} || ' Foods Llc (Dba Other)')", f"('Jo ' || {s} || ' Jr.')", f"({s} || ' & Sons Company')", "(CAST('3849-0001' AS STRING))", f"({s} || ' Bay Trust')",
        ),
    )


def _digits(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS STRING), {n}, '0')"


LOCATIONS = {
    "ord": "c_custkey",
    "brand": pick("c_custkey", ("Alpha Grill", "Beta Pizza", "Gamma Care", "Delta Diner", "Echo Subs")),
    "franchisee_name": _name("c_custkey"),
    "raw_address": f"CASE WHEN c_custkey % 19 = 0 THEN '' ELSE CAST(c_custkey % 400 AS STRING) || ' ' || {pick('c_custkey', ('Main Street', 'Oak Avenue, Suite 4', 'Lake Blvd.', 'Hill Road Unit 2', 'FL Turnpike', '5th Lane'))} END",
    "city": pick("c_custkey * 3", ("springfield", "OGDEN", "st. george", "provo")),
    "state": pick("c_custkey * 7", ("TX", "UT", "CA", "FL", "NY", "CO", "", "tx", "Nevada")),
    "zip": f"CASE WHEN c_custkey % 23 = 0 THEN '' ELSE {_digits('(c_custkey * 37) % 99999', 5)} END",
    "restaurant_phone": f"CASE c_custkey % 4 WHEN 0 THEN '(555) 010-' || {_digits('c_custkey % 10000', 4)} WHEN 1 THEN '555/010-' || {_digits('c_custkey % 10000', 4)} WHEN 2 THEN '1555010' || {_digits('c_custkey % 10000', 4)} ELSE '' END",
    "file": pick("c_custkey", ("a_raw.csv", "b_raw.csv", "c_raw.csv", "d_raw.csv", "e_raw.csv")),
}

_R = "o_orderkey"
_FIRM = f"(upper({pick(f'{_R} * 3', STEMS)}))"
REGISTRY = {
    "rid": _R,
    "firm": f"{_FIRM} || {pick(f'{_R} * 11', (' FOODS LLC', ' HOLDINGS, INC.', ' RESTAURANTS', ' GROUP', ' AND SONS CO.', ' FOODS, LLC, Delinquent May 1, 2016', ' BAY TRUST'))}",
    "status": pick(f"{_R} * 7", ("Good Standing", "Noncompliant", "Delinquent", "Administratively Dissolved", "Voluntarily Dissolved", "Exists")),
    "flag": pick(_R, ("A", "A", "I")),
    "kind": pick(f"{_R} * 5", ("DLLC", "FLLC", "DPC", "FPC", "XYZ")),
    "filing": pick(f"{_R} * 5", ("DOMP", "FORP", "FLAL", "FORL")),
    "mmddyyyy": f"{_digits(f'{_R} % 12 + 1', 2)} || {_digits(f'{_R} % 28 + 1', 2)} || CAST(1980 + {_R} % 45 AS STRING)",
    "iso": f"CASE WHEN {_R} % 29 = 0 THEN '' WHEN {_R} % 31 = 0 THEN 'unknown' ELSE CAST(1980 + {_R} % 45 AS STRING) || '-' || {_digits(f'{_R} % 12 + 1', 2)} || '-' || {_digits(f'{_R} % 28 + 1', 2)} END",
    "jurisdiction": pick(f"{_R} * 13", ("New York, United States", "Delaware", "", "California", "TX")),
    "street": f"CAST({_R} % 90 AS STRING) || ' ' || {pick(_R, ('Main Street', 'Oak Avenue Suite 4', 'Lake Blvd', 'Hill Road'))}",
    "street2": f"CASE WHEN {_R} % 3 = 0 THEN CAST({_R} % 90 AS STRING) || ' ' || {pick(_R, ('Main St', 'Oak Ave Suite 4', 'Lake', 'Hill Road'))} ELSE '77 Other Way' END",
    "town": pick(f"{_R} * 3", ("Springfield", "Ogden", "", "Provo")),
    "st": pick(f"{_R} * 7", ("TX", "UT", "NY")),
    "post": f"CASE WHEN {_R} % 5 = 0 THEN '' ELSE {_digits(f'({_R} * 37) % 99999', 5)} END",
    "first": pick(_R, ("PAT", "JO", "", "SAM")),
    "last": pick(_R, ("DOE", "ROE", "", "LAW")),
    "org": pick(f"{_R} * 3", ("", "", "Example Registered Agents Inc", "Smith Attorney Group", "")),
    "officer": pick(f"{_R} * 7", ("DOE PAT", "", "ROE JO", "BIG PARENT LLC")),
    "title": pick(_R, ("V", "P", "S", "D", "MGR")),
}


def spark_table(df: DataFrame, columns: dict[str, str], only: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a sample table, unused ones never computed."""
    return df.selectExpr(*(f"{e} AS {n}" for n, e in columns.items() if not only or n in only))


def duck_table(name: str, columns: dict[str, str]) -> str:
    """The same as a DuckDB subquery."""
    return "(SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {name})"


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw location records."""
    return spark_table(spread(spark.read.parquet(f"{sf_dir}/customer.parquet")), LOCATIONS)


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk registry records, before they take a state's shape."""
    return spark_table(spread(spark.read.parquet(f"{sf_dir}/orders.parquet")), REGISTRY)


LOC_SQL = duck_table("customer", LOCATIONS)
REG_SQL = duck_table("orders", REGISTRY)
