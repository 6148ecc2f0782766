import itertools
import json

import pytest
from pyspark.sql import functions as F

from stallwise.operators import drift as drift_ops
from stallwise.plans import monitoring, retraining
from stallwise.sources import catalog, sinks


@pytest.mark.parametrize(
    "alerts, longest",
    [([True, True, False, True], 2), ([False, False], 0), ([], 0), ([True, None, True], 1), ([True] * 4, 4)],
)
def test_longest_run(spark, alerts, longest):
    # months 2020-01, 2020-03, ...: an absent month does not break a run
    rows = [(f"2020-{1 + 2 * i:02d}", a) for i, a in enumerate(alerts)]
    df = spark.createDataFrame(rows, "period string, roc_auc_alert boolean")
    assert retraining.longest_alert_run(df).first()[0] == longest


@pytest.mark.parametrize("fired", list(itertools.product([False, True], repeat=3)))
def test_decision_truth_table(spark, fired):
    names = ("performance", "drift", "calendar")
    parts = [
        spark.createDataFrame([(n, 3, 2, f)], "trigger_name string, measured bigint, needed bigint, fired boolean")
        for n, f in zip(names, fired)
    ]
    got = {r["trigger_name"] for r in retraining.retrain_decision(*parts).collect()}
    assert got == {n for n, f in zip(names, fired) if f}
    assert [r["trigger_name"] for r in retraining.retrain_decision(*parts, force=True).collect()] == ["force"]


def test_drift_trigger_ignores_undefined(spark):
    df = spark.createDataFrame([(0.2,), (0.3,), (None,), (float("nan"),), (0.19,)], "psi double")
    row = retraining.trigger_drift(df).first()
    assert (row["measured"], row["fired"]) == (2, False)


@pytest.mark.parametrize(
    "old, new, promoted",
    [(0.7, 0.7, False), (0.7, 0.71, True), (None, 0.5, True), (0.7, None, False), (None, None, False)],
)
def test_promotion_rule(spark, old, new, promoted):
    values = {"champion_roc_auc": old, "challenger_roc_auc": new}
    for side, m in itertools.product(("champion", "challenger"), ("precision", "recall", "f1")):
        values[f"{side}_{m}"] = 0.5
    df = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])
    assert retraining.with_decision(df).first()["promoted"] is promoted


def test_next_version(spark):
    got = spark.range(1).select(retraining.next_version(F.lit(" V9 ")), retraining.next_version(F.lit("10"))).first()
    assert tuple(got) == ("v10", "v11")


def test_alert_needs_a_defined_auc(spark):
    from stallwise.operators import classification

    df = spark.createDataFrame([(None,), (0.64,), (0.66,)], "roc_auc double")
    got = [r[0] for r in df.select(classification.auc_alert(0.7, 0.05)).collect()]
    assert got == [False, True, False]


def test_report_round_trip(spark, tmp_path):
    scored = spark.createDataFrame(
        [(i, i / 20, int(i >= 10), f"2020-0{1 + i % 2}-05", int(i % 3 == 0)) for i in range(20)],
        "order_id int, predicted_probability double, predicted_class int, order_date string, actual_is_delayed int",
    ).withColumn("order_date", F.to_date("order_date"))
    flat = spark.createDataFrame([(1.0, "a")] * 20, "order_hour double, customer_state string")
    run = F.lit("2020-03-01 00:00:00").cast("timestamp")
    report = monitoring.monitoring_report(scored, drift_ops.drift_report(flat, flat), run, 0.9)
    path = str(tmp_path / "reports")
    sinks.append_report(report, path)
    sinks.append_report(report.withColumn("run_at", F.lit("2019-01-01").cast("timestamp")), path)
    row = sinks.latest_report(spark.read.parquet(path)).first()
    assert row["run_at"].year == 2020
    text = json.loads(row["report_json"])
    assert text["overall"]["n_rows"] == 20 and len(text["monthly_windows"]) == 2
    assert text["drift"]["numeric"] == [{"feature": "order_hour", "psi": None, "status": "unknown"}]
    assert "NaN" not in row["report_json"]
    latest = sinks.latest_report(spark.read.parquet(path))
    assert monitoring.read_windows(latest).count() == 2
    assert monitoring.read_numeric_drift(latest).first()["psi"] is None


def test_baseline_choice(spark):
    registry = spark.createDataFrame([(0.78, None)], "roc_auc_val double, train_snapshot string")
    assert tuple(monitoring.baseline_lookup(registry).first()) == (0.78, "train_v1")
    assert monitoring.baseline_lookup(registry, 0.6).first()[0] == 0.6
    assert tuple(monitoring.baseline_lookup(registry.where("false")).first()) == (None, "train_v1")


def test_absent_sources_are_left_out(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00123,"a ""b"", c",sp\n')
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        'review_answer_timestamp\nr,o,5,,"two\nlines",2018-01-01 00:00:00,\n'
    )
    tables = catalog.load_sources(spark, catalog.bind_sources(str(tmp_path)))
    assert set(tables) == {"sellers", "order_reviews"}
    assert tuple(tables["sellers"].first()) == ("s1", "00123", 'a "b", c', "sp")
    assert tables["order_reviews"].first()["review_comment_message"] == "two\nlines"
    assert {r["table_name"]: r["n_rows"] for r in catalog.row_audit(tables).collect()} == {"sellers": 1, "order_reviews": 1}


def test_prediction_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    base = spark.createDataFrame([("o", 0.5, 1)], "order_id string, predicted_probability double, predicted_class int")
    for version, day, p in (("1", "2020-01-01", 0.1), ("2", "2020-01-01", 0.2), ("2", "2020-01-02", 0.3), ("2", "2020-01-02", 0.4)):
        sinks.write_predictions(
            base.withColumn("predicted_probability", F.lit(p)).withColumn("model_version", F.lit(version))
            .withColumn("prediction_timestamp", F.lit(day).cast("timestamp")), path,
        )
    got = sorted((r["model_version"], str(r["run_date"]), r["predicted_probability"]) for r in sinks.read_predictions(spark, path).collect())
    assert got == [("1", "2020-01-01", 0.1), ("2", "2020-01-01", 0.2), ("2", "2020-01-02", 0.4)]
    assert sinks.read_predictions(spark, path, "2").count() == 2
