from datetime import datetime

from pyspark.sql import functions as F

from stallwise.plans import features, marts, metrics, staging

T0 = datetime(2020, 1, 1)


def test_payment_rollup(spark):
    rows = [("o", 1, "b", 2, 10.1), ("o", 2, "a", 5, 0.2), ("o", 3, "b", 1, 0.1), ("o", 4, None, 1, 0.3)]
    df = spark.createDataFrame(
        rows, "order_id string, payment_sequence int, payment_type string, payment_installments int, payment_value double"
    )
    row = marts.payments_aggregated(df).first()
    assert (row["total_payment_value"], row["payment_installments_max"], row["payment_count"]) == (10.7, 5, 4)
    assert (row["payment_method_count"], row["payment_type_list"]) == (2, "a, b")


def test_payment_types_all_null(spark):
    df = spark.createDataFrame([("o", None, 1, 1.0)], "order_id string, payment_type string, payment_installments int, payment_value double")
    row = marts.payments_aggregated(df).first()
    assert (row["payment_method_count"], row["payment_type_list"]) == (0, None)


def test_totals_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3).alias("order_id"), F.lit("x").alias("payment_type"), F.lit(1).alias("payment_installments"),
        ((F.col("id") * 37 % 1000) / 100).alias("payment_value"),
    )
    results = {
        n: sorted(map(tuple, marts.payments_aggregated(df.repartition(n, F.rand(n))).collect())) for n in (1, 3, 7)
    }
    assert results[1] == results[3] == results[7]


def test_latest_review_tie(spark):
    rows = [("r3", "o", T0), ("r1", "o", datetime(2020, 1, 2)), ("r2", "o", datetime(2020, 1, 2)), ("r0", "o", None)]
    df = spark.createDataFrame(rows, "review_id string, order_id string, review_created_at timestamp_ntz")
    assert [r["review_id"] for r in marts.latest_review(df).collect()] == ["r1"]


def test_primary_line(spark):
    rows = [("o", 2, "p2", "s2", 9.0, 1.0), ("o", 1, "p1", "s1", 8.0, 2.0), ("o", 3, "p3", "s3", None, 1.0),
            ("n", 1, "p9", "s9", None, None)]
    items = spark.createDataFrame(
        rows, "order_id string, item_sequence int, product_id string, seller_id string, price double, freight_value double"
    )
    products = spark.createDataFrame([("p1", "  ")], "product_id string, product_category_name string")
    got = {r["order_id"]: (r["product_id"], r["product_category"]) for r in marts.primary_line(items, products).collect()}
    assert got == {"o": ("p1", "uncategorized"), "n": ("p9", "uncategorized")}
    summary = {r["order_id"]: (r["item_count"], r["seller_id"]) for r in marts.item_summary(items).collect()}
    assert summary == {"o": (3, "s1"), "n": (1, "s9")}


def test_geolocation_modes_and_means(spark):
    rows = [("1", 1.0, 2.0, " B", "sp"), ("1", 3.0, None, "A", "rj"), ("1", 5.0, 4.0, "A", "sp"),
            ("1", 7.0, 6.0, " B", None), ("2", None, None, None, None)]
    df = spark.createDataFrame(
        rows, "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    )
    got = {r["zip_code_prefix"]: tuple(r)[1:] for r in staging.stg_geolocation(df).collect()}
    assert got["1"] == (4.0, 4.0, "b", "SP")  # tied cities: the smallest raw value, then normalised
    assert got["2"] == (None, None, None, None)


def test_one_row_per_person(spark):
    rows = [("c2", "u", "1", "x", "SP"), ("c1", "u", "2", "y", "RJ"), ("c3", "v", "3", "z", "MG")]
    df = spark.createDataFrame(
        rows, "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
        "customer_state string"
    )
    got = {r["customer_unique_id"]: r["customer_state"] for r in marts.dim_customers(df).collect()}
    assert got == {"u": "RJ", "v": "MG"}


def test_order_core_keeps_orders_without_items_and_drops_unknown_customers(spark):
    orders = spark.createDataFrame(
        [("o1", "c", "delivered", T0, None, None, T0, T0), ("o2", "gone", "delivered", T0, None, None, T0, T0)],
        "order_id string, customer_id string, order_status string, order_purchased_at timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_at timestamp_ntz, "
        "order_delivered_customer_at timestamp_ntz, order_estimated_delivery_at timestamp_ntz",
    )
    customers = spark.createDataFrame([("c", "u")], "customer_id string, customer_unique_id string")
    items = spark.createDataFrame(
        [], "order_id string, item_sequence int, product_id string, seller_id string, price double, freight_value double"
    )
    payments = spark.createDataFrame(
        [], "order_id string, payment_type string, payment_installments int, payment_value double"
    )
    core = marts.order_core(orders, payments, items, customers)
    rows = core.collect()
    assert [(r["order_id"], r["item_count"], r["total_freight_value"], r["seller_id"]) for r in rows] == [("o1", 0, 0.0, None)]
    assert metrics.met_daily_gmv(core).count() == 0  # no line item: not a valid order
    assert metrics.met_daily_delay_rate(core).first()["delay_rate"] == 0.0


def history(spark, rows):
    df = spark.createDataFrame(rows, "seller_id string, order_purchased_at timestamp_ntz, order_id string, delivery_days int")
    got = features.seller_history(df).collect()
    return {r["order_id"]: r["seller_avg_delivery_days_historical"] for r in got}


def test_seller_history(spark):
    rows = [("s", T0, "a", 4), ("s", T0, "b", None), ("s", T0, "c", 8), ("s", datetime(2020, 1, 3), "d", 1),
            (None, T0, "x", 2), (None, datetime(2020, 1, 2), "y", 5)]
    expected = {"a": None, "b": 4.0, "c": 4.0, "d": 6.0, "x": None, "y": 2.0}
    assert history(spark, rows) == expected


def test_hot_seller_history_equals_brute_force(spark):
    """One seller has most rows, many at one instant."""
    rows = []
    for i in range(400):
        seller = "hot" if i % 10 else f"s{i % 3}"
        moment = T0 if i % 4 else datetime(2020, 1, 1 + i % 20)
        rows.append((seller, moment, f"o{i:04d}", None if i % 7 == 0 else i % 30))
    expected = {}
    for seller, moment, order, _ in rows:
        earlier = [d for s, m, o, d in rows if s == seller and (m, o) < (moment, order) and d is not None]
        expected[order] = sum(earlier) / len(earlier) if earlier else None
    assert history(spark, rows) == expected


def test_leakage_reasons(spark, data):
    assert features.leakage_check(data.features, data.delays).count() == 0


def test_missing_columns_are_named(spark):
    import pytest

    df = spark.range(1)
    assert len(features.missing_columns(df)) == 16
    with pytest.raises(ValueError, match="order_hour"):
        features.validate_columns(df)
