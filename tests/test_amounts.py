import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stallwise.functions.aggregates import HIGHEST, LOWEST, sum_amount
from stallwise.plans import metrics


def exact(values):
    """Sum of doubles, rounded once; fractions hold every bit."""
    return float(sum((Fraction(v) for v in values), Fraction(0)))


def sums(spark, groups, parts=3):
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    return {r.g: r.s for r in df.groupBy("g").agg(sum_amount("v").alias("s")).collect()}


def cases():
    rng = random.Random(6)
    out = [[0.1, 0.2], [0.1] * 10, [1e27], [1e27, 1.0, -1e27], [1e-13] * 1000, [1e16, 1.0, -1e16], [0.0], [-0.0], [5e-324], [-2.5, 2.5], [2.0**53, 1.0, 2.0**-60],
           [2.0**53, 1.0], [-(2.0**53), -1.0], [2.0**53, 1.0, 2.0**-90], [-(2.0**53), -1.0, -(2.0**-90)], [2.0**91, 2.0**-100], [1e-13, -1e-13, 3.5]]
    for _ in range(150):
        n, spread = rng.randint(1, 30), rng.choice([3, 30, 90])
        out.append([rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.uniform(-spread / 2, spread) for _ in range(n)])
    for _ in range(50):
        out.append([round(rng.uniform(0, 10_000), 2) for _ in range(rng.randint(1, 200))])
    for _ in range(50):  # cancelling sums
        values = [rng.random() * 2.0 ** rng.uniform(-40, 80) for _ in range(6)]
        out.append(values + [-v for v in values[:-1]])
    return out


def test_equals_fractions_over_any_partitioning(spark):
    groups = cases()
    kept = [[v for v in g if v == 0 or abs(v) > 2.0 ** (LOWEST + 53)] for g in groups]
    for parts in (1, 7):
        got = sums(spark, groups, parts)
        for i, values in enumerate(groups):
            if values == kept[i] and all(abs(v) < 2.0**HIGHEST for v in values):
                assert got[i] == exact(values), values
    assert got[2] == 1e27 and got[3] == 1.0 and got[4] == exact([1e-13] * 1000) and got[8] == 5e-324


def test_what_a_plain_sum_gives(spark):
    groups = [[1.0, math.inf], [-math.inf, 2.0], [math.inf, -math.inf], [1.0, math.nan], [1e300, 1e300], [1e308, 1e308], [1e300, 5.0, -1e300]]
    got = sums(spark, groups)
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and math.isnan(got[3])
    assert got[4] == 2e300 and got[5] == math.inf and got[6] == 5.0


def test_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (2, 1.5)], "g int, v double")
    got = {r.g: r.s for r in df.groupBy("g").agg(sum_amount("v").alias("s")).collect()}
    assert got == {1: None, 2: 1.5}
    assert df.where("g > 5").agg(sum_amount("v").alias("s")).first().s is None


@pytest.mark.parametrize("value", [math.nan, math.inf])
def test_daily_value_keeps_non_finite_amounts(spark, value):
    rows = [("delivered", 1, "2020-01-01", 5.0), ("delivered", 1, "2020-01-01", value), ("delivered", 1, "2020-01-02", None)]
    core = spark.createDataFrame(rows, "order_status string, item_count long, order_date string, total_payment_value double")
    got = {r.order_date: r.gmv for r in metrics.met_daily_gmv(core).collect()}
    assert (math.isnan(got["2020-01-01"]) if math.isnan(value) else got["2020-01-01"] == value) and got["2020-01-02"] == 0.0


def test_no_decimals_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0.5)], "g int, v double").groupBy("g").agg(sum_amount("v").alias("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "decimal" not in plan.lower() and "partial_sum" in plan
