"""Retraining triggers, champion/challenger comparison, promotion. Inputs are small result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators import classification, splits

METRICS = ["roc_auc", "precision", "recall", "f1"]


def longest_alert_run(monthly: DataFrame) -> DataFrame:
    """Longest run of alerting months among the months present; one row, 0 without an alert.

    Months of a run share the difference of two row numbers. Input is one row per month.
    """
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("period"))
    within = F.row_number().over(Window.partitionBy("roc_auc_alert").orderBy("period"))
    runs = (
        monthly.select("period", F.coalesce("roc_auc_alert", F.lit(False)).alias("roc_auc_alert"))
        .withColumn("island", position - within)
        .where("roc_auc_alert")
        .groupBy("island")
        .agg(F.count("*").alias("length"))
    )
    return runs.agg(F.coalesce(F.max("length"), F.lit(0)).alias("longest_run"))


def trigger(measure: DataFrame, value: str, needed: int, name: str) -> DataFrame:
    """(trigger_name, measured, needed, fired)."""
    return measure.select(
        F.lit(name).alias("trigger_name"),
        F.col(value).cast("bigint").alias("measured"),
        F.lit(needed).cast("bigint").alias("needed"),
        F.coalesce(F.col(value) >= F.lit(needed), F.lit(False)).alias("fired"),
    )


def trigger_performance(monthly: DataFrame, needed: int = contract.RETRAIN_ALERT_MONTHS) -> DataFrame:
    return trigger(longest_alert_run(monthly), "longest_run", needed, "performance")


def trigger_drift(
    numeric: DataFrame, psi: float = contract.RETRAIN_PSI, needed: int = contract.RETRAIN_PSI_FEATURES
) -> DataFrame:
    count = numeric.agg(F.count_if(fn.defined(F.col("psi")) & (F.col("psi") >= F.lit(psi))).alias("n_features"))
    return trigger(count, "n_features", needed, "drift")


def trigger_calendar(
    registry: DataFrame, today: Column, last_retrain: str = "trained_on", months: int = contract.RETRAIN_MONTHS
) -> DataFrame:
    passed = registry.select(fn.calendar_months(F.col(last_retrain), today).alias("months"))
    return trigger(passed, "months", months, "calendar")


def retrain_decision(
    performance: DataFrame, drift: DataFrame, calendar: DataFrame, force: bool = False
) -> DataFrame:
    """One row per reason to retrain; none means no retraining. ``force`` replaces all reasons."""
    if force:
        return performance.select(F.lit("force").alias("trigger_name"), F.lit("forced").alias("reason"))
    fired = performance.unionByName(drift).unionByName(calendar).where("fired")
    return fired.select(
        "trigger_name", F.concat_ws(" ", "trigger_name", F.col("measured").cast("string"), F.lit(">="),
                                    F.col("needed").cast("string")).alias("reason")
    )


def compare_models(both: DataFrame) -> DataFrame:
    """Champion and challenger on the same rows: metrics of both, differences, and whether to promote.

    ``both`` has one row per order: actual_is_delayed, p_champion, p_challenger. Promotion needs a
    strictly higher AUC, or a defined one where the champion's is undefined.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(f"p_{name}").alias("probability"))
            for name in ("champion", "challenger")
        ]
    )
    scored = both.select("actual_is_delayed", F.inline(pairs)).withColumn(
        "predicted", fn.predicted_class(F.col("probability"))
    )
    report = classification.quality_report(scored, "probability", "actual_is_delayed", "predicted", ["model"])
    one_row = report.agg(
        *[
            F.max(F.when(F.col("model") == name, F.col(metric))).alias(f"{name}_{metric}")
            for name in ("champion", "challenger")
            for metric in METRICS
        ]
    )
    return with_decision(one_row)


def with_decision(metrics: DataFrame) -> DataFrame:
    """Adds differences and the promotion flag to a row of champion_* and challenger_* metrics."""
    old, new = F.col("champion_roc_auc"), F.col("challenger_roc_auc")
    promoted = new.isNotNull() & (old.isNull() | (new > old))
    return metrics.select(
        "*",
        *[(F.col(f"challenger_{m}") - F.col(f"champion_{m}")).alias(f"delta_{m}") for m in METRICS],
        F.coalesce(promoted, F.lit(False)).alias("promoted"),
    )


def pair_scores(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """Both models' probabilities per order of the shared test slice."""
    old = champion.select("order_id", "actual_is_delayed", F.col("predicted_probability").alias("p_champion"))
    new = challenger.select("order_id", F.col("predicted_probability").alias("p_challenger"))
    return old.join(new, "order_id")


def next_version(version: Column) -> Column:
    number = F.regexp_replace(F.lower(F.trim(version)), "^v", "").cast("int")
    return F.concat(F.lit("v"), (number + 1).cast("string"))


def promote_registry(
    active: DataFrame,
    comparison: DataFrame,
    sizes: DataFrame,
    validation: DataFrame,
    trained_on: Column,
    train_cutoff: str,
) -> DataFrame:
    """The registry row after the decision: the next version when promoted, the active row otherwise.

    ``sizes`` is (split, n_rows); ``validation`` one row of the challenger's validation metrics.
    """
    counts = sizes.agg(
        *[
            F.max(F.when(F.col("split") == s, F.col("n_rows"))).alias(f"new_{s}_rows")
            for s in (splits.TRAIN, splits.VALIDATION, splits.TEST)
        ]
    )
    val = validation.select(*[F.col(m).alias(f"new_{m}_val") for m in METRICS])
    row = active.crossJoin(comparison).crossJoin(counts).crossJoin(val)
    version = next_version(F.col("version"))

    def pick(new: Column, old: str) -> Column:
        return F.when(F.col("promoted"), new).otherwise(F.col(old)).alias(old)

    return row.select(
        pick(trained_on, "trained_on"),
        pick(F.lit(train_cutoff).cast("date"), "train_cutoff"),
        pick(F.date_sub("test_start", 1), "validation_end"),
        "test_start",
        pick(F.concat(F.lit("train_"), version), "train_snapshot"),
        *[pick(F.col(f"new_{s}_rows"), f"{s}_rows") for s in ("train", "validation", "test")],
        *[pick(F.col(f"new_{m}_val"), f"{m}_val") for m in METRICS],
        *[pick(F.col(f"challenger_{m}"), f"{m}_test") for m in METRICS],
        pick(version, "version"),
    )


def registry_row(
    version: str,
    trained_on: Column,
    train_cutoff: str,
    test_start: str,
    sizes: DataFrame,
    metrics: DataFrame,
) -> DataFrame:
    """First registry row of a model. ``metrics`` has one row per held-out split."""
    counts = sizes.agg(
        *[
            F.max(F.when(F.col("split") == s, F.col("n_rows"))).alias(f"{s}_rows")
            for s in (splits.TRAIN, splits.VALIDATION, splits.TEST)
        ]
    )
    short = {"val": splits.VALIDATION, "test": splits.TEST}
    quality = metrics.agg(
        *[
            F.max(F.when(F.col("split") == name, F.col(m))).alias(f"{m}_{suffix}")
            for suffix, name in short.items()
            for m in METRICS
        ]
    )
    test_day = F.lit(test_start).cast("date")
    return counts.crossJoin(quality).select(
        F.lit(version).alias("version"),
        trained_on.alias("trained_on"),
        F.lit(train_cutoff).cast("date").alias("train_cutoff"),
        F.date_sub(test_day, 1).alias("validation_end"),
        test_day.alias("test_start"),
        F.lit(f"train_{version}").alias("train_snapshot"),
        "train_rows",
        "validation_rows",
        "test_rows",
        *[f"{m}_{suffix}" for suffix in short for m in METRICS],
    )
