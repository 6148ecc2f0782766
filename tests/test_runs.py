"""The monitoring and retraining runs on the driver's tables."""

import pytest
from pyspark.sql import functions as F

import query_registry as registry
from conftest import SF
from stallwise.plans import modeling, monitoring, retraining, runs
from stallwise.session import fresh_path


@pytest.fixture(scope="module")
def table(spark):
    return registry.Data(spark, SF).stored_features


@pytest.fixture(scope="module")
def report(spark, table):
    d = registry.Data(spark, SF)
    train = d.labelled_split(table).where("split = 'train'").drop("split")
    return runs.monitor(
        d.bridge, table, d.registry, lambda name: {"train_v1": train}[name], fresh_path(spark, "reports"), F.current_timestamp()
    )


def test_monitor_takes_the_registry_baseline(spark, report):
    auc = registry.Data(spark, SF).registry.first()["roc_auc_val"]
    assert report.select(F.get_json_object("report_json", "$.baseline_roc_auc").cast("double")).first()[0] == auc
    assert monitoring.read_windows(report).count() > 3


def test_monitor_without_baseline(spark, table):
    d = registry.Data(spark, SF)
    with pytest.raises(ValueError, match="no baseline"):
        runs.monitor(d.bridge, table, d.registry.limit(0), lambda name: table, "unused", F.current_timestamp())


@pytest.mark.parametrize("state, trained, want", [("2020-03-01", "2019-01-01", "2020-03-01"), (None, "2019-01-01", "2019-01-01"), (None, None, "2000-01-01")])
def test_last_retrain_falls_back(spark, state, trained, want):
    df = spark.createDataFrame([(trained,)], "trained_on string").select(F.col("trained_on").cast("date"))
    assert str(runs.last_retrained(df, state).first()[0]) == want
    assert str(runs.last_retrained(df.limit(0), None).first()[0]) == "2000-01-01"


def test_first_model_is_promoted_then_compared(spark, table, report):
    models = fresh_path(spark, "models")
    none = registry.Data(spark, SF).registry.limit(0)
    first = runs.retrain(table, none, report, models, F.lit("2001-01-01").cast("date"), registry.VALIDATION_START, registry.TEST_START, force=True)
    row = first.registry.first()
    assert first.promoted and (row["version"], row["algorithm"]) == ("v1", "logistic_regression")
    assert row["path"].endswith("/v1") and spark.read.parquet(row["features_parquet"]).count() == row["train_rows"]
    second = runs.retrain(table, first.registry, report, models, F.lit("2001-07-01").cast("date"), registry.EXTENDED_END, registry.TEST_START, force=True)
    after = second.registry.first()
    assert after["version"] == ("v2" if second.promoted else "v1") and second.reasons == ["forced"]
    assert second.comparison.count() == 1


def test_no_reason_trains_nothing(spark, table, monkeypatch):
    quiet = spark.createDataFrame([('{"monthly_windows":[],"drift":{"numeric":[]}}',)], "report_json string")
    active = registry.Data(spark, SF).registry
    done = runs.retrain(table, active, quiet, "unused", F.lit("2001-07-01").cast("date"), registry.EXTENDED_END, registry.TEST_START, state="2001-06-30")
    assert done.reasons == [] and not done.promoted and done.comparison is None


def test_repeated_category_is_an_error(spark, table):
    path = fresh_path(spark, "broken")
    vocabulary = spark.createDataFrame([("f", "a", 1, 0), ("f", "a", 1, 1)], "feature string, category string, n_rows long, slot int")
    vocabulary.write.parquet(f"{path}/v9/vocabulary")
    with pytest.raises(ValueError, match="two slots"):
        modeling.load(spark, path, "v9")


def test_next_version(spark):
    assert spark.range(1).select(retraining.next_version(F.lit("v9"))).first()[0] == "v10"
