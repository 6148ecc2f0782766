import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.operators import drift


def reference_psi(base, cur, bins=10):
    base, cur = base[~np.isnan(base)], cur[~np.isnan(cur)]
    if len(base) < bins or len(cur) < 10:
        return None
    edges = np.unique(np.quantile(base, np.arange(bins + 1) / bins))
    if len(edges) < 3:
        return None
    e, a = (np.histogram(x, edges)[0] for x in (base, cur))
    e, a = (np.clip(x / max(x.sum(), 1), 1e-6, 1) for x in (e, a))
    return float(((a - e) * np.log(a / e)).sum())


def frames(spark, base, cur, column="x"):
    def make(values):
        rows = [(None if np.isnan(v) else float(v),) for v in values]
        return spark.createDataFrame(rows, f"{column} double")

    return make(base), make(cur)


@pytest.mark.parametrize("shift", [0.0, 0.7, 50.0])
def test_psi_equals_numpy(spark, shift):
    rng = np.random.default_rng(3)
    base = np.round(rng.normal(size=400), 2)
    cur = np.round(rng.normal(size=300) + shift, 2)
    base[::17] = np.nan
    row = drift.numeric_drift(*frames(spark, base, cur), ["x", "absent"]).first()
    assert row["feature"] == "x"
    assert row["psi"] == pytest.approx(reference_psi(base, cur), abs=1e-9)


def test_psi_undefined(spark):
    few, many, flat = np.arange(9.0), np.arange(50.0), np.ones(50)
    for base, cur in ((few, many), (many, few), (flat, many)):
        row = drift.numeric_drift(*frames(spark, base, cur), ["x"]).first()
        assert (row["psi"], row["status"]) == (None, "unknown")


def test_psi_of_equal_samples_is_zero(spark):
    x = np.arange(100.0)
    row = drift.numeric_drift(*frames(spark, x, x), ["x"]).first()
    assert row["psi"] == pytest.approx(0.0, abs=1e-12) and row["status"] == "ok"


@pytest.mark.parametrize("n", [1, 2, 5, 101, 256])
@pytest.mark.parametrize("parts", [2, 10])
def test_quantiles_equal_numpy(spark, n, parts):
    rng = np.random.default_rng(n)
    x = np.round(rng.exponential(size=n), 1)  # many repeats
    ranked = drift.with_ranks(drift.numeric_counts(*frames(spark, x, x[:0]), ["x"]))
    got = {r["part"]: r["edge"] for r in drift.quantiles(ranked, parts).collect()}
    want = np.quantile(x, np.arange(parts + 1) / parts)
    assert [got[i] for i in range(parts + 1)] == pytest.approx(list(want), abs=1e-12)


def test_category_shift(spark):
    base = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)], "c string")
    cur = spark.createDataFrame([("a",)] * 5 + [("z",)] * 5, "c string")
    row = drift.categorical_drift(base, cur, ["c"]).first()
    assert (row["status"], row["worst_category"], row["max_abs_share_diff"]) == ("alert", "z", 0.5)
    top = drift.top_shifts(drift.category_shares(base, cur, ["c"]), 3).orderBy("rank").collect()
    assert [r["category"] for r in top] == ["z", "b", "__NULL__"]


def test_worst_category_tie_takes_the_first(spark):
    base = spark.createDataFrame([("b",), ("a",)], "c string")
    cur = spark.createDataFrame([("c",), ("d",)], "c string")
    assert drift.categorical_drift(base, cur, ["c"]).first()["worst_category"] == "a"


@pytest.mark.parametrize("statuses, expected", [(["ok", "unknown"], "ok"), (["ok", "warning"], "warning"), (["alert", "warning"], "alert")])
def test_worst_of(spark, statuses, expected):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert drift.overall_status(df, df.where(F.lit(False))).first()[0] == expected
