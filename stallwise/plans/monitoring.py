"""Model quality over time, error cost, drift, and the monitoring report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators import classification
from stallwise.operators.drift import DriftReport

SCORE, LABEL, CLASS = "predicted_probability", "actual_is_delayed", "predicted_class"


def scored_frame(bridge: DataFrame) -> DataFrame:
    """Predictions whose outcome and order date are known."""
    return bridge.where(F.col(LABEL).isNotNull() & F.col("order_date").isNotNull()).select(
        "order_id", SCORE, CLASS, "order_date", LABEL
    )


def with_period(scored: DataFrame) -> DataFrame:
    return scored.withColumn("period", fn.month_label(F.col("order_date")))


def monthly_confusion(scored: DataFrame) -> DataFrame:
    return classification.confusion_matrix(with_period(scored), LABEL, CLASS, ["period"])


def monthly_metrics(scored: DataFrame, baseline_auc: float, delta: float = contract.AUC_ALERT_DELTA) -> DataFrame:
    """One row per month present, in order, with an alert when AUC fell more than delta below baseline."""
    report = classification.quality_report(with_period(scored), SCORE, LABEL, CLASS, ["period"])
    return report.select(
        "period", "n_rows", "roc_auc", "precision", "recall", "f1",
        classification.auc_alert(baseline_auc, delta).alias("roc_auc_alert"),
    ).orderBy("period")


def overall_metrics(scored: DataFrame, baseline_auc: float, delta: float = contract.AUC_ALERT_DELTA) -> DataFrame:
    """One row: quality, alert and error cost of all scored orders."""
    report = classification.quality_report(scored, SCORE, LABEL, CLASS)
    return report.select(
        "n_rows", "roc_auc", "precision", "recall", "f1",
        classification.auc_alert(baseline_auc, delta).alias("roc_auc_below_baseline_alert"),
        *classification.cost_columns(contract.FALSE_POSITIVE_COST, contract.FALSE_NEGATIVE_COST),
    )


def baseline_lookup(
    registry: DataFrame, configured_auc: float | None = None, default_snapshot: str = "train_v1"
) -> DataFrame:
    """(baseline_roc_auc, train_snapshot): configuration first, then the active model, then the default."""
    configured = F.lit(configured_auc).cast("double")
    return registry.agg(
        F.coalesce(configured, F.max("roc_auc_val")).alias("baseline_roc_auc"),
        F.coalesce(F.max("train_snapshot"), F.lit(default_snapshot)).alias("train_snapshot"),
    )


def rows_as_list(df: DataFrame, order: str, name: str) -> DataFrame:
    """All rows of a small result as one sorted list of structs."""
    fields = [c for c in df.columns if c != order]
    return df.agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias(name))


def monitoring_report(
    scored: DataFrame,
    drift: DriftReport,
    run_at: Column,
    baseline_auc: float,
    delta: float = contract.AUC_ALERT_DELTA,
    fraction: float = contract.TOP_FRACTION,
) -> DataFrame:
    """(run_at, report_json): one nested document per run.

    Only results of bounded size are nested: one overall row, one row per month, one per feature.
    Undefined numbers are written as null.
    """
    cost = [
        "true_negatives", "false_positives", "false_negatives", "true_positives",
        "estimated_cost_false_positives", "estimated_cost_false_negatives", "estimated_total_cost",
        "cost_ratio_fn_to_fp",
    ]
    top = classification.precision_at_top(scored, SCORE, LABEL, "order_id", fraction)
    overall = overall_metrics(scored, baseline_auc, delta).crossJoin(top).select(
        F.struct(
            "n_rows", "roc_auc", "precision", "recall", "f1", "precision_at_k",
            F.lit(float(fraction)).alias("k_fraction"),
            "roc_auc_below_baseline_alert",
            F.struct(*cost).alias("cost_analysis"),
        ).alias("overall")
    )
    months = rows_as_list(monthly_metrics(scored, baseline_auc, delta), "period", "monthly_windows")
    numeric = rows_as_list(drift.numeric, "feature", "numeric")
    shifts = drift.shifts.groupBy("feature").agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "category", "baseline_share", "current_share", "abs_diff"))
        ).alias("top_shifts")
    )
    categorical = rows_as_list(drift.categorical.join(shifts, "feature", "left"), "feature", "categorical")
    thresholds = F.struct(
        F.lit(contract.PSI_WARNING).alias("psi_ok_max"),
        F.lit(contract.PSI_ALERT).alias("psi_warning_max"),
        F.lit(contract.SHARE_WARNING).alias("categorical_warning_diff"),
        F.lit(contract.SHARE_ALERT).alias("categorical_alert_diff"),
    )
    # every side is a single row
    row = overall.crossJoin(months).crossJoin(numeric).crossJoin(categorical).crossJoin(drift.overall)
    document = F.struct(
        run_at.cast("string").alias("run_timestamp_utc"),
        F.lit(float(baseline_auc)).alias("baseline_roc_auc"),
        F.lit(float(delta)).alias("roc_auc_alert_delta"),
        "overall",
        "monthly_windows",
        F.exists("monthly_windows", lambda w: w["roc_auc_alert"]).alias("any_monthly_roc_alert"),
        F.struct("overall_status", "numeric", "categorical", thresholds.alias("thresholds")).alias("drift"),
        F.struct("overall_status").alias("drift_summary"),
    )
    return row.select(
        run_at.alias("run_at"), F.to_json(document, {"ignoreNullFields": "false"}).alias("report_json")
    )


def read_windows(report: DataFrame) -> DataFrame:
    """Monthly windows of a stored report, one row per month."""
    schema = "monthly_windows array<struct<period: string, n_rows: bigint, roc_auc: double, roc_auc_alert: boolean>>"
    return report.select(F.inline(F.from_json("report_json", schema)["monthly_windows"]))


def read_numeric_drift(report: DataFrame) -> DataFrame:
    """Numeric drift rows of a stored report."""
    schema = "drift struct<numeric: array<struct<feature: string, psi: double, status: string>>>"
    return report.select(F.inline(F.from_json("report_json", schema)["drift"]["numeric"]))
