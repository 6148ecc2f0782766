"""The declared quality contract of the datasets and its runner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import aggregates as ag
from stallwise.operators import checks
from stallwise.plans import features, metrics

# What must hold, per dataset.
NOT_NULL = {
    "stg_orders": ["order_id", "customer_id", "order_status", "order_purchased_at"],
    "stg_order_items": ["order_id", "item_sequence", "product_id", "seller_id", "price", "freight_value"],
    "stg_order_payments": [
        "order_id", "payment_sequence", "payment_type", "payment_installments", "payment_value",
    ],
    "stg_order_reviews": ["review_id", "order_id", "review_score"],
    "stg_customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ],
    "stg_sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "stg_products": ["product_id", "product_category_name"],
    "stg_geolocation": ["zip_code_prefix", "latitude", "longitude", "city", "state"],
    "payments_aggregated": [
        "order_id", "total_payment_value", "payment_installments_max", "payment_method_count",
        "payment_type_list", "payment_count",
    ],
    "order_status_normalized": ["order_id", "raw_status", "normalized_status", "is_delivered", "is_canceled"],
    "int_orders_enriched": [
        "order_id", "customer_id", "order_purchased_at", "order_status", "normalized_status", "is_delivered",
        "is_canceled",
    ],
    "dim_customers": ["customer_key", "customer_unique_id"],
    "dim_sellers": ["seller_key", "seller_id"],
    "dim_products": ["product_key", "product_id"],
    "fact_orders": ["order_id", "customer_key"],
    "fact_order_items": ["order_id", "order_item_id", "product_id", "seller_id", "product_key", "seller_key"],
    "met_daily_gmv": ["order_date", "gmv"],
    "met_daily_revenue": ["order_date", "revenue"],
    "met_daily_delay_rate": ["order_date", "delay_rate", "delivered_eligible_orders", "delayed_orders"],
    "order_features": ["order_id", "order_purchase_timestamp"],
    "fct_predictions": [
        "order_id", "predicted_probability", "predicted_class", "model_version", "prediction_timestamp",
    ],
}
UNIQUE = [
    ("stg_orders", ["order_id"]),
    ("stg_customers", ["customer_id"]),
    ("stg_sellers", ["seller_id"]),
    ("stg_products", ["product_id"]),
    ("stg_geolocation", ["zip_code_prefix"]),
    ("payments_aggregated", ["order_id"]),
    ("order_status_normalized", ["order_id"]),
    ("int_orders_enriched", ["order_id"]),
    ("dim_customers", ["customer_key"]),
    ("dim_customers", ["customer_unique_id"]),
    ("dim_sellers", ["seller_key"]),
    ("dim_sellers", ["seller_id"]),
    ("dim_products", ["product_key"]),
    ("dim_products", ["product_id"]),
    ("fact_orders", ["order_id"]),
    ("met_daily_gmv", ["order_date"]),
    ("met_daily_revenue", ["order_date"]),
    ("met_daily_delay_rate", ["order_date"]),
    ("order_features", ["order_id"]),
    ("fct_predictions", ["order_id"]),
    ("stg_order_items", ["order_id", "item_sequence"]),
    ("stg_order_payments", ["order_id", "payment_sequence"]),
    ("fact_order_items", ["order_id", "order_item_id"]),
]
ACCEPTED = [
    ("stg_orders", "order_status", contract.ORDER_STATUSES),
    ("stg_order_payments", "payment_type", contract.PAYMENT_TYPES),
    ("stg_order_reviews", "review_score", [1, 2, 3, 4, 5]),
    ("order_status_normalized", "normalized_status", [*contract.STATUS_GROUPS, contract.OTHER_STATUS]),
    ("order_status_normalized", "is_delivered", [0, 1]),
    ("order_status_normalized", "is_canceled", [0, 1]),
    ("fct_predictions", "predicted_class", [0, 1]),
]
RELATIONSHIPS = [
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("fact_orders", "customer_key", "dim_customers", "customer_key"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_order_items", "product_key", "dim_products", "product_key"),
    ("fact_order_items", "seller_key", "dim_sellers", "seller_key"),
]


def paid_total() -> Column:
    return metrics.paid()


def valid_with_items() -> Column:
    return F.col("order_status").isin(contract.VALID_STATUSES) & metrics.has_items()


def delivered_with_items() -> Column:
    return (F.col("order_status") == "delivered") & metrics.has_items()


def gmv_mismatch(daily: DataFrame, core: DataFrame) -> DataFrame:
    """Daily GMV total against the valid orders of the fact, dated or not."""
    return checks.totals_differ(daily, ag.sum_amount("gmv"), core.where(valid_with_items()), paid_total())


def revenue_mismatch(daily: DataFrame, core: DataFrame) -> DataFrame:
    return checks.totals_differ(daily, ag.sum_amount("revenue"), core.where(delivered_with_items()), paid_total())


class Unplanned(dict):
    """Stands for tables that are not there yet, where only the declared counts are asked for."""

    def __missing__(self, name: str) -> None:
        return None


def declared(tables: dict[str, DataFrame], as_of: Column) -> checks.Suite:
    """All declared checks over the datasets but the one on leakage. ``tables`` holds the datasets by name, plus ``order_core``."""
    suite = checks.Suite()
    for name, columns in NOT_NULL.items():
        suite.not_null(name, tables[name], columns)
    for name, column, values in ACCEPTED:
        suite.accepted_values(name, tables[name], column, values)
    for name, columns in UNIQUE:
        suite.unique(name, tables[name], columns)
    for name, column, parent, parent_column in RELATIONSHIPS:
        suite.relationships(name, tables[name], column, tables[parent], parent_column, parent)
    suite.not_later_than("stg_orders", tables["stg_orders"], "order_purchased_at", as_of)
    suite.unit_interval("met_daily_delay_rate", tables["met_daily_delay_rate"], "delay_rate")
    suite.unit_interval("fct_predictions", tables["fct_predictions"], "predicted_probability", null_is_bad=True)
    for left, right in (("fact_order_items", "stg_order_items"), ("fct_predictions", "order_features")):
        suite.equal_rowcount(left, tables[left], right, tables[right])
    core = tables["order_core"]
    for name, column, statuses in (("met_daily_gmv", "gmv", contract.VALID_STATUSES), ("met_daily_revenue", "revenue", ["delivered"])):
        named = ", ".join(f"'{status}'" for status in statuses)
        paid = f"case when order_status in ({named}) and item_count >= 1 then coalesce(total_payment_value, 0.0D) end"
        suite.equal_totals(name, column, tables[name], ag.sum_amount(column), "order_core", core, ag.sum_amount(paid))
    return suite


def quality_suite(tables: dict[str, DataFrame], as_of: Column) -> checks.Suite:
    """All declared checks over the datasets, which should be stored: each is read twice, those of the leakage check once more.

    Counts that ``build`` observed while it wrote a table (``tables.observed``) are taken as they are.
    """
    suite = declared(tables, as_of)
    for name, found in getattr(tables, "observed", {}).items():
        suite.take(name, found)
    return suite.rows(
        "no_leakage", "order_features", "order_id",
        features.leakage_check(tables["order_features"], tables["int_orders_enriched"]),
    )
