import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.operators import classification as cl
from stallwise.operators import prefix


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, p double, y int").withColumn("c", (F.col("p") >= 0.5).cast("int"))


def pair_auc(rows):
    late = [p for _, p, y in rows if y == 1]
    on_time = [p for _, p, y in rows if y == 0]
    if not late or not on_time:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in late for b in on_time) / (len(late) * len(on_time))


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(5)
    return [(i, round(rng.random(), 1), int(rng.random() < 0.3)) for i in range(300)]


def test_auc_equals_pairs(spark, sample):
    report = cl.quality_report(frame(spark, sample), "p", "y", "c").first()
    assert report["roc_auc"] == pytest.approx(pair_auc(sample), abs=1e-12)
    assert report["n_rows"] == 300


@pytest.mark.parametrize(
    "rows, auc",
    [([(1, 0.3, 1), (2, 0.3, 0)], 0.5), ([(1, 0.9, 1), (2, 0.1, 0)], 1.0), ([(1, 0.1, 1), (2, 0.9, 0)], 0.0),
     ([(1, 0.1, 1), (2, 0.9, 1)], None), ([], None)],
)
def test_auc_edges(spark, rows, auc):
    assert cl.roc_auc(frame(spark, rows), "p", "y").first()["roc_auc"] == auc


def test_rates_are_zero_on_empty_denominators(spark):
    row = cl.classification_metrics(frame(spark, [(1, 0.1, 1), (2, 0.2, 0)]), "y", "c").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_cost(spark):
    row = cl.cost_analysis(frame(spark, [(1, 0.9, 0), (2, 0.1, 1), (3, 0.2, 1)]), "y", "c").first()
    assert (row["estimated_total_cost"], row["cost_ratio_fn_to_fp"]) == (110.0, 5.0)


@pytest.mark.parametrize("fraction", [0.001, 0.1, 0.37, 1.0])
def test_precision_at_top(spark, sample, fraction):
    k = max(1, int(np.ceil(fraction * len(sample))))
    best = sorted(sample, key=lambda r: (-r[1], r[0]))[:k]
    row = cl.precision_at_top(frame(spark, sample), "p", "y", "k", fraction).first()
    assert (row["k"], row["precision_at_k"]) == (k, pytest.approx(sum(r[2] for r in best) / k))


@pytest.mark.parametrize("n, k", [(3, 1), (11, 2), (0, 0)])
def test_places(spark, n, k):
    """All scores tied: the lowest keys fill the places."""
    rows = [(i, 0.5, int(i == 0)) for i in range(n)]
    row = cl.precision_at_top(frame(spark, rows), "p", "y", "k", 0.1).first()
    assert (row["k"], row["precision_at_k"]) == (k, 1 / k if k else 0.0)


def test_running_sums(spark):
    """Groups of very different sizes, null group included; the partitioning of the input does not matter."""
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), i, rng.choice([None, 1, 2, 5])) for i in range(200)]
    expected = {
        i: sum(v or 0 for g2, i2, v in rows if g2 == g and i2 < i) for g, i, _ in rows
    }
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "g string, i int, v int").repartition(parts)
        got = prefix.running_sums(df, ["g"], [F.col("i")], {"before": F.col("v")})
        assert {r["i"]: r["before"] for r in got.collect()} == expected


def test_range_slices_follow_the_order(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 7 % 5000)
    sliced = prefix.range_sliced(df, [F.col("x")], 4)
    bounds = sliced.groupBy(prefix.SLICE).agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy(prefix.SLICE).collect()
    assert len(bounds) > 1
    assert all(bounds[i]["b"] < bounds[i + 1]["a"] for i in range(len(bounds) - 1))


def test_hot_score_and_value_are_sliced(spark):
    """One score on 90 % of the rows: ranks by key are right and the tied rows lie in several slices."""
    rows = [(i, 0.5 if i % 10 else i / 1000, int(i % 3 == 0)) for i in range(600)]
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[:60]
    row = cl.precision_at_top(frame(spark, rows), "p", "y", "k", 0.1).first()
    assert row["precision_at_k"] == pytest.approx(sum(r[2] for r in best) / 60)
    sliced = prefix.range_sliced(frame(spark, rows), [F.col("p"), F.col("k")])
    assert sliced.where("p = 0.5").select(prefix.SLICE).distinct().count() > 1


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_scores(spark, missing):
    """One rule: no class, no AUC and no precision among the top, but every row counts."""
    from stallwise.functions import columns as fn

    rows = [(1, 0.9, 1), (2, 0.1, 0), (3, missing, 0)]
    df = spark.createDataFrame(rows, "k int, p double, y int").withColumn("c", fn.predicted_class(F.col("p")))
    assert [r["c"] for r in df.orderBy("k").collect()] == [1, 0, None]
    report = cl.quality_report(df, "p", "y", "c").first()
    assert (report["n_rows"], report["roc_auc"], report["tp"], report["tn"], report["fp"]) == (3, None, 1, 1, 0)
    top = cl.precision_at_top(df, "p", "y", "k", 0.3).first()
    assert (top["k"], top["precision_at_k"]) == (1, None)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_windows_look_at_slices_only(spark, sample):
    """Row windows are within a slice; the one window over whole groups sees a row per slice."""
    report = plan(cl.quality_report(frame(spark, sample), "p", "y", "c"))
    windows = [line for line in report.split("\n") if "Window [" in line]
    assert windows and all("_slice" in line for line in windows)
