"""Order-level intermediate results, dimensions and facts.

``order_core`` is the wide internal order row: status, delays, payments, item summary, primary line and
person. The published fact, the metrics and the features are narrow reads of it. Every side joined on
order_id has been aggregated to one row per order first, so those joins cannot fan out and no order
number can be hot in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import aggregates as ag
from stallwise.functions import columns as fn


def payments_aggregated(payments: DataFrame) -> DataFrame:
    """One row per order, with the number and the sorted list of its distinct types.

    The declared types are bits of a number, so the aggregate over all payments keeps fixed-size sums in a hash map. Only types
    that are not declared are collected, in an aggregate over the rows that have them.
    """
    kind, known = F.col("payment_type"), sorted(contract.PAYMENT_TYPES)
    bit = F.lit(0).cast("bigint")
    for i, name in enumerate(known):
        bit = F.when(kind == name, F.lit(1 << i).cast("bigint")).otherwise(bit)
    per_order = payments.groupBy("order_id").agg(
        ag.sum_amount("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.bit_or(bit).alias("bits"),
        F.count("*").alias("payment_count"),
    )
    undeclared = payments.where(kind.isNotNull() & ~kind.isin(known))
    listed = undeclared.where("order_id is not null").groupBy(F.col("order_id").alias("_order")).agg(F.collect_set(kind).alias("_others"))
    # payments without an order are one group: a single row
    missing = F.col("order_id").isNull()
    orderless = undeclared.where(missing).groupBy(missing.alias("_missing")).agg(F.collect_set(kind).alias("_orderless"))
    others = F.coalesce(F.when(missing, F.col("_orderless")).otherwise(F.col("_others")), F.array().cast("array<string>"))
    declared = F.filter(F.array(*[F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(known)]), lambda t: t.isNotNull())
    per_order = per_order.join(listed, F.col("order_id") == F.col("_order"), "left").join(F.broadcast(orderless), missing == F.col("_missing"), "left")
    return per_order.withColumn("types", F.sort_array(F.concat(declared, others))).select(
        "order_id",
        "total_payment_value",
        "payment_installments_max",
        F.size("types").cast("bigint").alias("payment_method_count"),
        F.when(F.size("types") > 0, F.array_join("types", ", ")).alias("payment_type_list"),
        "payment_count",
    )


def status_columns() -> list:
    """Status group and flags, computed where the order row already is."""
    status = F.col("order_status")
    return [
        fn.status_group(status).alias("normalized_status"),
        fn.flag(status == "delivered").alias("is_delivered"),
        fn.flag(status == "canceled").alias("is_canceled"),
    ]


def order_status_normalized(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.col("order_status").alias("raw_status"), *status_columns())


def latest_review(reviews: DataFrame) -> DataFrame:
    """Newest review per order, lowest review_id on a tie; planned as a partial and a final group limit."""
    newest = Window.partitionBy("order_id").orderBy(
        F.col("review_created_at").desc_nulls_last(), F.col("review_id").asc_nulls_last()
    )
    return reviews.withColumn("position", F.row_number().over(newest)).where("position = 1").drop("position")


def with_delays(orders: DataFrame) -> DataFrame:
    """Orders with status columns and delivery measures."""
    delivered_at, promised_at = F.col("order_delivered_customer_at"), F.col("order_estimated_delivery_at")
    is_delivered = F.col("is_delivered")
    return orders.select("*", *status_columns()).select(
        "*",
        fn.delivery_days(is_delivered, F.col("order_purchased_at"), delivered_at).alias("delivery_days"),
        fn.calendar_days(F.col("order_purchased_at"), promised_at).alias("estimated_delivery_days"),
        fn.delay_days(is_delivered, promised_at, delivered_at).alias("delay_days"),
        fn.late_flag(is_delivered, promised_at, delivered_at).alias("is_delayed"),
    )


# The published column order.
ENRICHED_COLUMNS = [
    "order_id", "customer_id", "order_purchased_at", "order_approved_at", "order_delivered_carrier_at",
    "order_delivered_customer_at", "order_estimated_delivery_at", "order_status", "normalized_status",
    "is_delivered", "is_canceled", "total_payment_value", "payment_installments_max", "payment_method_count",
    "payment_type_list", "payment_count", "review_score", "review_comment_title", "review_comment_message",
    "delivery_days", "estimated_delivery_days", "delay_days", "is_delayed",
]


def int_orders_enriched(
    orders: DataFrame, payments: DataFrame, reviews: DataFrame, aggregated: DataFrame | None = None
) -> DataFrame:
    """``aggregated``: the payments per order where they are stored already."""
    review = latest_review(reviews).select(
        "order_id", "review_score", "review_comment_title", "review_comment_message"
    )
    return (
        with_delays(orders)
        .join(payments_aggregated(payments) if aggregated is None else aggregated, "order_id", "left")
        .join(review, "order_id", "left")
        .select(*ENRICHED_COLUMNS)
    )


def line_value():
    return F.col("price") + F.col("freight_value")


def item_rollup(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(*rollup_aggregates())


def rollup_aggregates() -> list:
    return [
        F.count("*").alias("item_count"),
        ag.sum_amount("freight_value").alias("total_freight_value"),
    ]


def primary_line_aggregate():
    """Dearest line, then lowest sequence, as a maximum: it combines map-side and needs no sort by value.

    A null compares lowest inside a struct, so lines without a value lose, as with nulls last.
    """
    return F.max(
        F.struct(
            line_value().alias("line_value"),
            (-F.col("item_sequence")).alias("earliest"),
            "product_id",
            "seller_id",
        )
    ).alias("primary")


def item_summary(items: DataFrame) -> DataFrame:
    """Rollup and primary line from one scan and one shuffle of the lines."""
    return (
        items.groupBy("order_id")
        .agg(*rollup_aggregates(), primary_line_aggregate())
        .select("order_id", "item_count", "total_freight_value", "primary.product_id", "primary.seller_id")
    )


def primary_line(items: DataFrame, products: DataFrame) -> DataFrame:
    """Seller and category of the primary line; only winning lines look up their product."""
    winners = items.groupBy("order_id").agg(primary_line_aggregate()).select("order_id", "primary.*")
    return (
        winners.join(product_categories(products), "product_id", "left")
        .select(
            "order_id", "seller_id", "product_id", "line_value",
            F.coalesce("product_category", F.lit(contract.NO_CATEGORY)).alias("product_category"),
        )
    )


def product_categories(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        fn.default_if_blank(F.col("product_category_name"), contract.NO_CATEGORY).alias("product_category"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per person: the row with the lowest customer_id."""
    first = Window.partitionBy("customer_unique_id").orderBy(
        F.col("customer_id").asc_nulls_last(), "customer_zip_code_prefix", "customer_city", "customer_state"
    )
    return (
        customers.withColumn("position", F.row_number().over(first))
        .where("position = 1")
        .select(
            fn.surrogate_key(F.col("customer_unique_id")).alias("customer_key"),
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "customer_zip_code_prefix",
        )
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        fn.surrogate_key(F.col("seller_id")).alias("seller_key"),
        "seller_id",
        "seller_city",
        "seller_state",
        "seller_zip_code_prefix",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        fn.surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id",
        fn.default_if_blank(F.col("product_category_name"), contract.NO_CATEGORY).alias("product_category"),
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
    )


def fact_order_items(items: DataFrame, products_dim: DataFrame, sellers_dim: DataFrame) -> DataFrame:
    """Lines whose product and seller are known, with both surrogate keys.

    A key is a function of the id, as in the dimensions, so the lines are shuffled without these digests.
    """
    return (
        items.join(products_dim.select("product_id"), "product_id")
        .join(sellers_dim.select("seller_id"), "seller_id")
        .select(
            "order_id",
            F.col("item_sequence").alias("order_item_id"),
            "product_id",
            "seller_id",
            fn.surrogate_key(F.col("product_id")).alias("product_key"),
            fn.surrogate_key(F.col("seller_id")).alias("seller_key"),
            "price",
            "freight_value",
        )
    )


def orders_wide(orders: DataFrame, aggregated: DataFrame, reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with all that is looked up by order_id: delays, payments, latest review, item summary.

    Every side has one row per order, so the enriched orders are columns of this table and the core its rows of known
    customers. ``aggregated``: the payments per order.
    """
    review = latest_review(reviews).select("order_id", "review_score", "review_comment_title", "review_comment_message")
    return (
        with_delays(orders)
        .join(aggregated, "order_id", "left")
        .join(review, "order_id", "left")
        .join(item_summary(items), "order_id", "left")
    )


def order_core(
    orders: DataFrame, payments: DataFrame, items: DataFrame, customers: DataFrame, aggregated: DataFrame | None = None
) -> DataFrame:
    """Orders of known customers with payments, item summary and the person's key.

    The person dimension is built from the same customer table, so every non-null person has a row in
    it and the key is a function of the person. One lookup by customer_id therefore does the work of
    the two-hop join, and the orders are shuffled once less. ``aggregated``: the payments per order where they are stored already.
    """
    return with_dates(
        with_delays(orders)
        .join(persons(customers), "customer_id")
        .join(payments_aggregated(payments) if aggregated is None else aggregated, "order_id", "left")
        .join(item_summary(items), "order_id", "left")
    )


def persons(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("customer_unique_id").isNotNull()).select("customer_id", "customer_unique_id")


def core_of(wide: DataFrame, customers: DataFrame) -> DataFrame:
    """``order_core`` from stored wide orders; it keeps their review score."""
    return with_dates(wide.drop("review_comment_title", "review_comment_message").join(persons(customers), "customer_id"))


def with_dates(joined: DataFrame) -> DataFrame:
    """The key is a digest that would not shrink in a shuffle, so it is worked out after the joins."""
    return (
        joined.withColumn("customer_key", fn.surrogate_key(F.col("customer_unique_id")))
        .withColumn("order_date", F.to_date("order_purchased_at"))
        .withColumn("delivery_date", F.to_date("order_delivered_customer_at"))
        .withColumn("estimated_delivery_date", F.to_date("order_estimated_delivery_at"))
        .withColumn("item_count", F.coalesce("item_count", F.lit(0)).cast("bigint"))
        .withColumn("total_freight_value", F.coalesce("total_freight_value", F.lit(0.0)))
    )


def with_review_and_category(core: DataFrame, reviews: DataFrame, products: DataFrame) -> DataFrame:
    """The core plus the two lookups only the published fact needs."""
    return with_category(core.join(latest_review(reviews).select("order_id", "review_score"), "order_id", "left"), products)


def with_category(reviewed: DataFrame, products: DataFrame) -> DataFrame:
    return (
        reviewed.join(product_categories(products), "product_id", "left")
        .withColumn(
            "product_category",
            F.when(F.col("item_count") > 0, F.coalesce("product_category", F.lit(contract.NO_CATEGORY))),
        )
    )


# The published column order.
FACT_COLUMNS = [
    "order_id", "customer_key", "order_date", "delivery_date", "estimated_delivery_date", "item_count",
    "total_freight_value", "product_category", "seller_id", "total_payment_value", "delivery_days",
    "delay_days", "is_delayed", "review_score",
]


def fact_orders(wide: DataFrame) -> DataFrame:
    """The published order fact: a narrow read of the wide order row."""
    return wide.select(*FACT_COLUMNS)
