"""What several layers need is worked out once, and digests are worked out after the joins."""

from __future__ import annotations

import driver_tables
from stallwise.plans import marts

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
    l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"""


def test_lines_are_numbered_once_for_both_tables(spark, tmp_path):
    rows = [
        (1, 5, 7, 1, 3.0, 10.5, 0.0, 0.0, "A", "O", "1996-01-02"), (1, 4, 7, 1, 2.0, 9.5, 0.0, 0.0, "N", "O", "1996-01-03"),
        (1, 4, 7, None, None, 1.0, 0.0, 0.0, None, "O", None), (None, 1, 1, 2, 1.0, 2.0, 0.0, 0.0, "R", "F", "1996-01-02"),
        (2, 4, 7, 3, 12.0, 1.0, 0.0, 0.0, "R", "F", "1996-01-02"), (2, 4, 7, 3, 12.0, 1.0, 0.0, 0.0, "R", "F", "1996-01-02"),
    ]
    df = spark.createDataFrame(rows, LINES)
    df.withColumn("l_shipdate", df["l_shipdate"].cast("timestamp_ntz")).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain = driver_tables.RawTables(spark, str(tmp_path))
    stored = driver_tables.RawTables(spark, str(tmp_path)).with_stored_lines()
    for name in ("order_items", "order_payments"):
        assert stored[name].dtypes == plain[name].dtypes
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, plain[name].collect()))
        plan = stored[name]._jdf.queryExecution().sparkPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan


def test_digests_do_not_travel_through_the_joins(spark):
    items = spark.createDataFrame([(1, 1, 4, 7, 1.0, 2.0)], "order_id bigint, item_sequence int, product_id bigint, seller_id bigint, price double, freight_value double")
    products = spark.createDataFrame([(4, "x")], "product_id bigint, product_category_name string").selectExpr("*", "0 weight_g", "0 length_cm", "0 height_cm", "0 width_cm")
    sellers = spark.createDataFrame([(7, "1", "a", "B")], "seller_id bigint, seller_zip_code_prefix string, seller_city string, seller_state string")
    dims = marts.dim_products(products), marts.dim_sellers(sellers)
    joined = marts.fact_order_items(items, *dims)
    below = joined._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert "md5" not in below
    row = joined.first()
    assert (row["product_key"], row["seller_key"]) == (dims[0].first()["product_key"], dims[1].first()["seller_key"])
