"""Aggregates over all rows keep fixed-size sums, so that they work in hash maps without sorting their input."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from stallwise.operators import drift
from stallwise.plans import marts

PAYMENTS = "order_id bigint, payment_type string, payment_installments int, payment_value double"


def plan_of(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_payments_per_order_are_summed_in_a_hash_map(spark):
    df = spark.createDataFrame([(1, "voucher", 1, 2.0)], PAYMENTS)
    summed = [line for line in plan_of(marts.payments_aggregated(df)).splitlines() if "payment_value" in line and "Aggregate" in line]
    assert summed and all(re.search(r"[^t]HashAggregate", line) and "collect_set" not in line for line in summed)


def test_types_that_are_not_declared_and_payments_without_an_order(spark):
    rows = [
        (1, "voucher", 1, 2.0), (1, "gold", 2, 1.0), (1, "boleto", None, None), (1, "gold", 1, 0.5), (1, None, 1, 0.5),
        (2, None, None, None), (3, "credit_card", 3, 3.0), (None, "silver", 1, 1.0), (None, "voucher", 2, 1.5), (4, "", 1, 1.0),
    ]
    df = spark.createDataFrame(rows, PAYMENTS).repartition(3)
    found = {r["order_id"]: tuple(r)[1:] for r in marts.payments_aggregated(df).collect()}
    assert found == {
        1: (4.0, 2, 3, "boleto, gold, voucher", 5), 2: (None, None, 0, None, 1), 3: (3.0, 3, 1, "credit_card", 1),
        None: (2.5, 2, 2, "silver, voucher", 2), 4: (1.0, 1, 1, "", 1),
    }


def test_values_are_counted_by_the_place_of_their_feature(spark):
    base = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    now = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    counts = drift.value_counts(base, now, ["a", "b"], lambda c: c)
    assert "keys=[place" in plan_of(counts)
    assert sorted(map(tuple, counts.where(F.col("value").isNotNull()).collect())) == [("a", 1.0, 2, 1), ("a", 3.0, 0, 1), ("b", 2.0, 1, 3)]
    assert sorted(map(tuple, counts.where("value is null").collect())) == [("a", None, 0, 1), ("b", None, 1, 0)]
