"""Daily metrics over the order core. The status travels with the order, so no metric joins again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import aggregates as ag
from stallwise.functions import columns as fn


def has_items():
    return F.col("item_count") >= 1


def valid_orders(core: DataFrame) -> DataFrame:
    return core.where(
        F.col("order_status").isin(contract.VALID_STATUSES) & has_items() & F.col("order_date").isNotNull()
    )


def delivered_orders(core: DataFrame) -> DataFrame:
    return core.where((F.col("order_status") == "delivered") & has_items() & F.col("order_date").isNotNull())


def delay_eligible(core: DataFrame) -> DataFrame:
    present = ["delivery_date", "estimated_delivery_date", "is_delayed", "order_date"]
    condition = F.col("order_status") == "delivered"
    for name in present:
        condition = condition & F.col(name).isNotNull()
    return core.where(condition)


def paid():
    return ag.sum_amount("coalesce(total_payment_value, 0.0D)")


def met_daily_gmv(core: DataFrame) -> DataFrame:
    return valid_orders(core).groupBy("order_date").agg(paid().alias("gmv"))


def met_daily_revenue(core: DataFrame) -> DataFrame:
    return delivered_orders(core).groupBy("order_date").agg(paid().alias("revenue"))


def met_daily_delay_rate(core: DataFrame) -> DataFrame:
    counted = delay_eligible(core).groupBy("order_date").agg(
        F.count("*").alias("delivered_eligible_orders"),
        ag.count_where(F.col("is_delayed") == 1).alias("delayed_orders"),
    )
    return counted.select(
        "order_date",
        fn.safe_divide(F.col("delayed_orders"), F.col("delivered_eligible_orders")).alias("delay_rate"),
        "delivered_eligible_orders",
        "delayed_orders",
    )
