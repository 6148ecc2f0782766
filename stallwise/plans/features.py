"""Order-level model features and the prediction bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators.prefix import running_mean_before

# The published column order.
FEATURE_COLUMNS = [
    "order_id", "order_purchase_timestamp", "order_day_of_week", "order_hour", "order_month",
    "total_payment_value", "payment_installments", "payment_type_count", "product_weight_g",
    "product_volume_cm3", "product_category", "customer_state", "seller_state", "customer_seller_same_state",
    "seller_avg_delivery_days_historical", "freight_value", "freight_ratio", "estimated_delivery_days",
    "seller_id", "is_delayed",
]


def calendar_columns(at: str) -> list:
    c = F.col(at)
    return [
        fn.weekday_from_sunday(c).alias("order_day_of_week"),
        F.hour(c).alias("order_hour"),
        F.month(c).alias("order_month"),
    ]


def seller_history(orders: DataFrame, stored: bool = False) -> DataFrame:
    """Adds the seller's mean delivery days over earlier orders.

    Earlier means by purchase time, then order_id. Orders without a seller share one history. The rows are cut
    into ranges of (seller, time, order), so a seller with a large share of all orders is worked on by many tasks.
    """
    return running_mean_before(
        orders,
        group="seller_id",
        order=[F.col("order_purchased_at").asc_nulls_last(), F.col("order_id").asc()],
        value="delivery_days",
        out="seller_avg_delivery_days_historical",
        stored=stored,
    )


CORE_INPUTS = [
    "order_id", "order_purchased_at", "customer_unique_id", "seller_id", "product_id", "delivery_days",
    "total_payment_value", "payment_installments_max", "payment_method_count", "total_freight_value",
    "estimated_delivery_days", "is_delayed",
]


def order_features(
    core: DataFrame, customers_dim: DataFrame, sellers_dim: DataFrame, products_dim: DataFrame, stored: bool = False
) -> DataFrame:
    """One row per order of the core; the history is taken on narrow rows before the lookups widen them.

    ``stored``: the core is a scan of a stored table.
    """
    same_state = fn.flag(F.col("customer_state") == F.col("seller_state"))
    return (
        seller_history(core.select(*CORE_INPUTS), stored)
        .join(customers_dim.select("customer_unique_id", "customer_state"), "customer_unique_id")
        .join(sellers_dim.select("seller_id", "seller_state"), "seller_id", "left")
        .join(products_dim.drop("product_key"), "product_id", "left")
        .select(
            "*",
            *calendar_columns("order_purchased_at"),
            F.col("order_purchased_at").alias("order_purchase_timestamp"),
            F.col("payment_installments_max").alias("payment_installments"),
            F.col("payment_method_count").alias("payment_type_count"),
            F.col("weight_g").alias("product_weight_g"),
            fn.volume(F.col("length_cm"), F.col("height_cm"), F.col("width_cm")).alias("product_volume_cm3"),
            same_state.alias("customer_seller_same_state"),
            F.col("total_freight_value").alias("freight_value"),
            fn.safe_divide(
                F.col("total_freight_value"), F.coalesce("total_payment_value", F.lit(0.0))
            ).alias("freight_ratio"),
        )
        .select(*FEATURE_COLUMNS)
    )


def fct_predictions(predictions: DataFrame, fact: DataFrame) -> DataFrame:
    """Every prediction with its order's person, date and outcome where the order is known."""
    outcome = fact.select("order_id", "customer_key", "order_date", F.col("is_delayed").alias("actual_is_delayed"))
    return predictions.join(outcome, "order_id", "left").select(
        "order_id", "predicted_probability", "predicted_class", "model_version", "prediction_timestamp",
        "customer_key", "order_date", "actual_is_delayed",
    )


def latest_predictions(bridge: DataFrame, n: int = 10) -> DataFrame:
    """The n newest orders with prediction and outcome; each task keeps n rows."""
    return bridge.orderBy(F.col("order_date").desc_nulls_last(), F.col("order_id")).limit(n)


# Violation texts.
LEAK_REASONS = {
    "label_unexpected": "is_delayed present but order not eligible for delay label",
    "label_absent": "is_delayed null but order eligible for delay label",
    "history_early": "first seller order must have null historical avg",
}


def leakage_check(features: DataFrame, orders: DataFrame) -> DataFrame:
    """(order_id, violation): labels that disagree with eligibility, and history on a seller's first order.

    ``orders`` carries status flags and delivery times per order.
    """
    eligible = (
        (F.col("is_delivered") == 1)
        & F.col("order_delivered_customer_at").isNotNull()
        & F.col("order_estimated_delivery_at").isNotNull()
    )
    label = F.col("is_delayed")
    paired = features.select("order_id", "is_delayed").join(
        orders.select("order_id", eligible.alias("is_eligible")), "order_id"
    )
    mislabelled = paired.select(
        "order_id",
        F.when(label.isNotNull() & ~F.col("is_eligible"), LEAK_REASONS["label_unexpected"])
        .when(label.isNull() & F.col("is_eligible"), LEAK_REASONS["label_absent"])
        .alias("violation"),
    ).where(F.col("violation").isNotNull())
    first = Window.partitionBy("seller_id").orderBy(
        F.col("order_purchase_timestamp").asc_nulls_last(), F.col("order_id").asc()
    )
    early = (
        features.where(F.col("seller_id").isNotNull())
        .select("order_id", "seller_id", "order_purchase_timestamp", "seller_avg_delivery_days_historical")
        .withColumn("position", F.row_number().over(first))
        .where("position = 1")
        .where(F.col("seller_avg_delivery_days_historical").isNotNull())
        .select("order_id", F.lit(LEAK_REASONS["history_early"]).alias("violation"))
    )
    return mislabelled.unionByName(early)


def missing_columns(df: DataFrame) -> list[str]:
    """Model columns the frame lacks; looks at the plan only."""
    return [c for c in contract.NUMERIC_FEATURES + contract.CATEGORICAL_FEATURES if c not in df.columns]


def validate_columns(df: DataFrame) -> DataFrame:
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"features lack expected columns: {missing}")
    return df


def feature_matrix(df: DataFrame) -> DataFrame:
    """Model inputs only: no identifiers, no time, no label."""
    dropped = {*contract.IDENTIFIER_COLUMNS, contract.LABEL}
    return df.select(*[c for c in df.columns if c not in dropped])


def coerce_features(df: DataFrame) -> DataFrame:
    """Numbers as double (bad text becomes null), categories as text with a token for null."""
    numbers = {c: fn.lenient_double(F.col(c)) for c in contract.NUMERIC_FEATURES if c in df.columns}
    texts = {
        c: fn.default_if_null(F.col(c).cast("string"), contract.MISSING_CATEGORY)
        for c in contract.CATEGORICAL_FEATURES
        if c in df.columns
    }
    return df.withColumns({**numbers, **texts})
