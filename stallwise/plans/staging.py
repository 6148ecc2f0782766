"""Cleaning: one projection per raw table, fixed names and types, one row in and one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        fn.as_timestamp(F.col("order_purchase_timestamp")).alias("order_purchased_at"),
        fn.as_timestamp(F.col("order_approved_at")).alias("order_approved_at"),
        fn.as_timestamp(F.col("order_delivered_carrier_date")).alias("order_delivered_carrier_at"),
        fn.as_timestamp(F.col("order_delivered_customer_date")).alias("order_delivered_customer_at"),
        fn.as_timestamp(F.col("order_estimated_delivery_date")).alias("order_estimated_delivery_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("order_item_id").alias("item_sequence"),
        "product_id",
        "seller_id",
        fn.as_timestamp(F.col("shipping_limit_date")).alias("shipping_limit_at"),
        fn.as_double(F.col("price")).alias("price"),
        fn.as_double(F.col("freight_value")).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("payment_sequential").alias("payment_sequence"),
        fn.normalized_text(F.col("payment_type")).alias("payment_type"),
        fn.as_int(F.col("payment_installments")).alias("payment_installments"),
        fn.as_double(F.col("payment_value")).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        fn.as_int(F.col("review_score")).alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        fn.as_timestamp(F.col("review_creation_date")).alias("review_created_at"),
        fn.as_timestamp(F.col("review_answer_timestamp")).alias("review_answered_at"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        fn.normalized_text(F.col("customer_city")).alias("customer_city"),
        fn.upper_code(F.col("customer_state")).alias("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        "seller_zip_code_prefix",
        fn.normalized_text(F.col("seller_city")).alias("seller_city"),
        fn.upper_code(F.col("seller_state")).alias("seller_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    category = fn.normalized_text(F.col("product_category_name"))
    return raw.select(
        "product_id",
        fn.default_if_null(category, contract.NO_CATEGORY).alias("product_category_name"),
        fn.as_int(F.col("product_name_lenght")).alias("product_name_length"),
        fn.as_int(F.col("product_description_lenght")).alias("product_description_length"),
        fn.as_int(F.col("product_photos_qty")).alias("product_photos_qty"),
        fn.as_double(F.col("product_weight_g")).alias("weight_g"),
        fn.as_double(F.col("product_length_cm")).alias("length_cm"),
        fn.as_double(F.col("product_height_cm")).alias("height_cm"),
        fn.as_double(F.col("product_width_cm")).alias("width_cm"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position and most frequent city and state, ties to the smallest.

    A first aggregate reduces the raw rows to distinct (prefix, city, state). The most frequent values
    are then found among those few rows, so no task ever holds the values of a busy prefix.
    """
    distinct = raw.groupBy(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    ).agg(
        F.sum(fn.as_double(F.col("geolocation_lat"))).alias("lat_sum"),
        F.count("geolocation_lat").alias("lat_n"),
        F.sum(fn.as_double(F.col("geolocation_lng"))).alias("lng_sum"),
        F.count("geolocation_lng").alias("lng_n"),
        F.count("*").alias("n"),
    )
    # one row per value and kind; the position sums travel with the city rows only
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    entries = F.array(
        F.struct(F.lit("city").alias("kind"), F.col("city").alias("value"), "lat_sum", "lat_n", "lng_sum", "lng_n"),
        F.struct(
            F.lit("state").alias("kind"), F.col("state").alias("value"),
            none.alias("lat_sum"), zero.alias("lat_n"), none.alias("lng_sum"), zero.alias("lng_n"),
        ),
    )
    per_value = (
        distinct.select("zip_code_prefix", "n", F.inline(entries))
        .groupBy("zip_code_prefix", "kind", "value")
        .agg(*[F.sum(c).alias(c) for c in ("n", "lat_sum", "lat_n", "lng_sum", "lng_n")])
    )
    most_frequent = F.struct((-F.col("n")).alias("rank"), "value")

    def top(kind: str):
        return F.min(F.when((F.col("kind") == kind) & F.col("value").isNotNull(), most_frequent))["value"]

    return per_value.groupBy("zip_code_prefix").agg(
        fn.safe_divide(F.sum("lat_sum"), F.sum("lat_n")).alias("latitude"),
        fn.safe_divide(F.sum("lng_sum"), F.sum("lng_n")).alias("longitude"),
        fn.normalized_text(top("city")).alias("city"),
        fn.upper_code(top("state")).alias("state"),
    )
