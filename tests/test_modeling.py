from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.operators import splits
from stallwise.plans import modeling
from stallwise.session import durable

NUMBERS, TEXTS = contract.NUMERIC_FEATURES, contract.CATEGORICAL_FEATURES


def feature_rows(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        numbers = [None if rng.random() < 0.05 else float(np.round(rng.normal() * 3, 2)) for _ in NUMBERS]
        texts = [f"c{int(v)}" if v < 6 else None for v in rng.integers(0, 7, len(TEXTS))]
        signal = (numbers[0] or 0.0) + (1.5 if texts[0] == "c1" else 0.0)
        rows.append((i, *numbers, *texts, int(rng.random() < 1 / (1 + np.exp(1 - signal)))))
    return rows


SCHEMA = ", ".join(
    ["order_id bigint", *[f"{c} double" for c in NUMBERS], *[f"{c} string" for c in TEXTS], "is_delayed int"]
)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = feature_rows(400)
    train = spark.createDataFrame(rows, SCHEMA)
    return rows, modeling.fit(train, "v1")


def design(rows, model):
    """The documented preparation in numpy."""
    columns = []
    for j, _ in enumerate(NUMBERS):
        x = np.array([np.nan if r[1 + j] is None else r[1 + j] for r in rows])
        x = np.where(np.isnan(x), np.nanmedian(x), x)
        columns.append((x - x.mean()) / x.std())
    for j, c in enumerate(TEXTS):
        values = [r[1 + len(NUMBERS) + j] or "missing" for r in rows]
        columns += [np.array([float(v == label) for v in values]) for label in model.labels[c]]
    return np.array(columns).T, np.array([r[-1] for r in rows], dtype=float)


def test_statistics(spark, fitted):
    rows, model = fitted
    for j, c in enumerate(NUMBERS):
        x = np.array([np.nan if r[1 + j] is None else r[1 + j] for r in rows])
        filled = np.where(np.isnan(x), np.nanmedian(x), x)
        assert model.numeric[c] == pytest.approx((np.nanmedian(x), filled.mean(), filled.std()), abs=1e-9)


def test_coefficients_equal_newton(fitted):
    rows, model = fitted
    x, y = design(rows, model)
    x1 = np.c_[x, np.ones(len(y))]
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) + penalty, x1.T @ (p - y) + penalty @ w)
    assert np.abs(np.array(model.classifier.coefficients) - w[:-1]).max() < 1e-3
    assert abs(model.classifier.intercept - w[-1]) < 1e-3


def test_score_keeps_rows_and_survives_storage(spark, fitted, tmp_path):
    rows, model = fitted
    extra = [(1000, *rows[0][1:14], "never seen", None, "c1", None)]
    features = spark.createDataFrame(rows + extra, SCHEMA)
    first = {r["order_id"]: r["predicted_probability"] for r in modeling.score(model, features).collect()}
    assert len(first) == 401 and all(0 <= p <= 1 for p in first.values())
    modeling.save(model, str(tmp_path))
    again = modeling.load(spark, str(tmp_path), "v1")
    second = {r["order_id"]: r["predicted_probability"] for r in modeling.score(again, features).collect()}
    assert second == first
    dry = modeling.score_dry_run(model, features).first()
    assert (dry["n_input"], dry["n_scored"]) == (401, 401)


def test_unseen_category_is_all_zeros(spark, fitted):
    rows, model = fitted
    features = spark.createDataFrame([(1, *rows[0][1:14], "never seen", "c1", "c1", None)], SCHEMA)
    vector = model.stages.transform(model.encoded(features)).first()["inputs"].toArray()
    n, k = len(NUMBERS), len(model.labels[TEXTS[0]])
    assert vector[n : n + k].sum() == 0 and vector[n + k :].sum() == 2


@pytest.mark.parametrize("n, kept", [(39, 39), (40, 39), (41, 39), (60, 39)])
def test_vocabulary_cap(spark, n, kept):
    rows = [(f"v{i:02d}",) for i in range(n) for _ in range(3 if i < 5 else 1)]
    df = spark.createDataFrame(rows, "product_category string")
    got = modeling.category_vocabulary(df, ["product_category"]).collect()
    own = [r["category"] for r in got if r["slot"] < 39]
    assert len(got) == n and len(own) == kept
    assert {f"v{i:02d}" for i in range(5)} <= set(own)
    if n > kept:  # later names win a tie
        assert "v05" not in own and f"v{n - 1}" in own


def test_splits(spark):
    df = spark.createDataFrame(
        [(1, "1998-12-31 23:59:59"), (2, "1999-01-01"), (3, "2000-01-01"), (4, None)], "id int, t string"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    split = splits.with_split(df, "t", "1999-01-01", "2000-01-01")
    assert {r["id"]: r["split"] for r in split.collect()} == {1: "train", 2: "validation", 3: "test"}
    with pytest.raises(ValueError, match="validation"):
        splits.require_splits(split.where("id <> 2"))
    with pytest.raises(ValueError, match="before test start"):
        splits.extended_split(df, "t", "2000-01-01", "2000-01-01")


def test_gate(spark):
    for auc, passed in ((0.6, True), (0.5, False), (None, False)):
        df = spark.createDataFrame([(auc,)], "roc_auc double")
        assert modeling.auc_gate(df, 0.55).first()["passed"] is passed


def test_top_coefficients(fitted):
    _, model = fitted
    rows = modeling.top_coefficients(model, 5).collect()
    sizes = [abs(r["coefficient"]) for r in rows]
    assert len(rows) == 5 and sizes == sorted(sizes, reverse=True)
    assert len(model.input_names()) == len(model.classifier.coefficients)


def many_categories(n, seed=3):
    """One state has nearly all rows; the first feature has thousands of categories, so its last slot is shared."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        numbers = [float(np.round(rng.normal(), 3)) for _ in NUMBERS]
        texts = [f"p{int(rng.integers(0, 3000))}" if i % 3 else "p-most", "SP" if i % 50 else "RJ", f"s{i % 5}"]
        rows.append((i, *numbers, *texts, int(i % 4 == 0)))
    return rows


def test_hot_state_and_a_vocabulary_beyond_broadcast(spark):
    rows = many_categories(6000)
    train = spark.createDataFrame(rows, SCHEMA)
    vocabulary = durable(modeling.category_vocabulary(train))
    labels = modeling.slot_labels(vocabulary)
    assert len(labels[TEXTS[0]]) == contract.MAX_CATEGORIES and labels[TEXTS[1]] == ["RJ", "SP"]
    slots = {(r["feature"], r["category"]): r["slot"] for r in vocabulary.collect()}
    seen = rows[:3000] + [(9000 + i, *rows[0][1:14], "p-unseen", "XX", None, None) for i in range(3000)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        numeric = {c: (0.0, 0.0, 1.0) for c in NUMBERS}
        encoded = modeling.encode(spark.createDataFrame(seen, SCHEMA).repartition(4), numeric, labels, vocabulary)
        plan = encoded._jdf.queryExecution().optimizedPlan().toString()
        got = encoded.select("order_id", *[f"_c_{c}" for c in TEXTS]).collect()
        sizes = [r["n"] for r in encoded.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)
    assert plan.count("Join LeftOuter") == sum(len(labels[c]) == contract.MAX_CATEGORIES for c in TEXTS) == 1  # no join for states
    texts = {r[0]: r[1 + len(NUMBERS) : -1] for r in seen}
    for row in got:
        for c, value in zip(TEXTS, texts[row["order_id"]]):
            assert row[f"_c_{c}"] == slots.get((c, value or "missing"), len(labels[c]))
    assert len(got) == 6000 and max(sizes) < 0.5 * 6000


def test_linear_scores_equal_the_fitted_stages(spark, fitted, tmp_path):
    rows, model = fitted
    features = spark.createDataFrame([*rows, (2000, *rows[0][1:14], "never seen", None, "c1", None)], SCHEMA)
    stages = model.stages.transform(model.encoded(features)).select("order_id", vector_to_array("probability")[1].alias("p"))
    want = {r["order_id"]: r["p"] for r in stages.collect()}
    got = {r["order_id"]: r["predicted_probability"] for r in modeling.score(model, features).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    modeling.save(model, str(tmp_path))
    loaded = modeling.load_linear(spark, str(tmp_path), "v1")
    assert {r["order_id"]: r["predicted_probability"] for r in modeling.score(loaded, features).collect()} == got
    assert [tuple(r) for r in modeling.top_coefficients(loaded, 5).collect()] == [tuple(r) for r in modeling.top_coefficients(model, 5).collect()]


def test_optimality_holds_at_the_fit_only(spark, fitted):
    rows, model = fitted
    train = spark.createDataFrame(rows, SCHEMA)
    x, y = design(rows, model)
    checked = {r["feature"]: r for r in modeling.optimality(model, train).collect()}
    assert len(checked) == x.shape[1] + 1 and all(r["optimal"] for r in checked.values())
    w = np.array(model.classifier.coefficients)
    p = 1 / (1 + np.exp(-(x @ w + model.classifier.intercept)))
    slopes = (x.T @ (p - y) + w) / len(y)
    assert [checked[name]["gradient"] for name in model.input_names()] == pytest.approx(list(slopes), abs=1e-9)
    linear = model.linear()
    moved = replace(linear, coefficients=[linear.coefficients[0] + 0.05, *linear.coefficients[1:]])
    assert not all(r["optimal"] for r in modeling.optimality(moved, train).collect())
