"""Quality of 0/1 predictions, overall or per group, from counts per distinct score.

Rows are first counted per (group, score): tied scores collapse map-side, and everything else
is computed from those counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import aggregates as ag
from stallwise.functions import columns as fn
from stallwise.operators.prefix import running_sums

CELLS = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}


def cell_counts(label: str, predicted: str) -> list:
    return [
        ag.count_where((F.col(label) == actual) & (F.col(predicted) == guess)).alias(name)
        for name, (actual, guess) in CELLS.items()
    ]


def confusion_matrix(scored: DataFrame, label: str, predicted: str, group: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    return scored.groupBy(*(group or [])).agg(*cell_counts(label, predicted))


def rates() -> list:
    tp, fp, fn_ = F.col("tp"), F.col("fp"), F.col("fn")
    return [
        ag.precision(tp, fp).alias("precision"),
        ag.recall(tp, fn_).alias("recall"),
        ag.f1(tp, fp, fn_).alias("f1"),
    ]


def classification_metrics(scored: DataFrame, label: str, predicted: str, group: list[str] | None = None) -> DataFrame:
    counts = confusion_matrix(scored, label, predicted, group)
    return counts.select(*(group or []), *rates())


def cost_analysis(
    scored: DataFrame,
    label: str,
    predicted: str,
    fp_cost: float = contract.FALSE_POSITIVE_COST,
    fn_cost: float = contract.FALSE_NEGATIVE_COST,
) -> DataFrame:
    return confusion_matrix(scored, label, predicted).select(*cost_columns(fp_cost, fn_cost))


def cost_columns(fp_cost: float, fn_cost: float) -> list:
    fp_total, fn_total = F.col("fp") * F.lit(float(fp_cost)), F.col("fn") * F.lit(float(fn_cost))
    return [
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
        fp_total.alias("estimated_cost_false_positives"),
        fn_total.alias("estimated_cost_false_negatives"),
        (fp_total + fn_total).alias("estimated_total_cost"),
        F.try_divide(F.lit(float(fn_cost)), F.lit(float(fp_cost))).alias("cost_ratio_fn_to_fp"),
    ]


def quality_report(
    scored: DataFrame, score: str, label: str, predicted: str, group: list[str] | None = None
) -> DataFrame:
    """Per group: n_rows, ROC-AUC, precision, recall, F1 and the four counts.

    AUC is the share of (late, on-time) pairs ranked the right way, ties counting half: per score,
    late rows times twice the on-time rows below plus the tied ones. The pair counts are exact decimals.
    It is null when a group has one class only or a missing score, null or NaN. All rows count in n_rows; rows
    without label or class are in none of the four counts. No group: one row, also for empty input.
    """
    group = group or []
    known = F.when(fn.defined(F.col(score)), F.col(score))
    per_score = scored.groupBy(*group, known.alias("_score")).agg(
        *cell_counts(label, predicted),
        F.count("*").alias("_n"),
        ag.count_where(F.col(label) == 1).alias("_late"),
        ag.count_where(F.col(label) == 0).alias("_on_time"),
    )
    ranked = running_sums(per_score, group, [F.col("_score").asc_nulls_last()], {"_below": F.col("_on_time")})
    pairs = F.col("_late").cast("decimal(19,0)") * (F.col("_below") * 2 + F.col("_on_time")).cast("decimal(19,0)")
    combined = ranked.groupBy(*group).agg(
        F.sum(pairs.cast("decimal(38,0)")).alias("_pairs"),
        F.coalesce(F.sum(F.when(F.col("_score").isNull(), F.col("_n"))), F.lit(0)).alias("_missing"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", "_late", "_on_time", *CELLS)],
    )
    all_pairs = F.lit(2.0) * F.col("_late") * F.col("_on_time")
    return combined.select(
        *group,
        F.col("_n").alias("n_rows"),
        F.when(F.col("_missing") == 0, fn.safe_divide(F.col("_pairs"), all_pairs)).alias("roc_auc"),
        *rates(),
        *CELLS,
    )


def roc_auc(scored: DataFrame, score: str, label: str, group: list[str] | None = None) -> DataFrame:
    constant = scored.withColumn("_class", F.lit(0))
    return quality_report(constant, score, label, "_class", group).select(*(group or []), "roc_auc")


def auc_alert(baseline_auc, delta: float):
    """Undefined AUC never alerts."""
    limit = baseline_auc if not isinstance(baseline_auc, (int, float)) else F.lit(float(baseline_auc))
    return F.coalesce(F.col("roc_auc") < limit - F.lit(delta), F.lit(False))


def precision_at_top(
    scored: DataFrame, score: str, label: str, key: str, fraction: float = contract.TOP_FRACTION
) -> DataFrame:
    """Share of late rows among the k highest scores, k = max(1, ceil(fraction * n)); 0 for no rows.

    Rows above the cut score all count. Of those tied at the cut, the ones with the lowest keys fill the
    remaining places; the tied rows are ranked by range slices, so they may be any share of the data. Undefined
    (null) when a score is missing, null or NaN.
    """
    scored = scored.withColumn(score, F.when(fn.defined(F.col(score)), F.col(score)))
    per_score = scored.groupBy(F.col(score).alias("_score")).agg(
        F.count("*").alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_late")
    )
    ranked = running_sums(
        per_score, [], [F.col("_score").desc_nulls_last()], {"_n_above": F.col("_n"), "_late_above": F.col("_late")}
    )
    total = ranked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"), F.max(F.col("_score").isNull()).alias("_missing")
    )
    k = F.greatest(F.lit(1), F.ceil(F.lit(float(fraction)) * F.col("_total")))
    # the cut is one row: the score at which the running count reaches k
    cut = (
        ranked.crossJoin(F.broadcast(total))
        .withColumn("_k", k.cast("bigint"))
        .where((F.col("_n_above") < F.col("_k")) & (F.col("_n_above") + F.col("_n") >= F.col("_k")))
        .select(
            F.col("_score").alias("_cut"),
            "_k",
            "_late_above",
            "_missing",
            (F.col("_k") - F.col("_n_above")).alias("_places"),
        )
    )
    tied = scored.join(F.broadcast(cut), F.col(score).eqNullSafe(F.col("_cut"))).select(
        key, F.col(label).cast("bigint").alias("_late"), "_places"
    )
    placed = running_sums(tied, [], [F.col(key).asc_nulls_last()], {"_position": F.lit(1).cast("bigint")})
    from_tie = placed.where(F.col("_position") < F.col("_places")).agg(
        F.coalesce(F.sum("_late"), F.lit(0)).alias("_late_tied")
    )
    hits = cut.crossJoin(F.broadcast(from_tie)).select(
        (F.col("_late_above") + F.col("_late_tied")).alias("_hits"), "_k", "_missing"
    )
    # the outer aggregate keeps one row when there are no scored rows at all
    return hits.agg(
        F.coalesce(F.sum("_k"), F.lit(0)).alias("k"),
        F.when(
            ~F.coalesce(F.max("_missing"), F.lit(False)),
            F.coalesce(fn.safe_divide(F.sum("_hits"), F.sum("_k")), F.lit(0.0)),
        ).alias("precision_at_k"),
    )
