"""The fallback sees every registry record."""

from millrace import registry


def test_odd_records_are_matched(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, 801, 2).selectExpr("id AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    assert registry.QUERIES["j_fuzzy_fallback"](spark, str(tmp_path)).count() > 0
