"""Distribution shift between a baseline and a current dataset, all features from one scan per side.

Both sides are counted into one table of (feature, value, baseline_n, current_n). Repeated values
collapse map-side, so a value that fills a third of the rows costs one row. Quantiles, histograms
and shares are read off that table; no task holds the values of a feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators.prefix import running_sums
from stallwise.session import durable


def shared_features(baseline: DataFrame, current: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in baseline.columns and c in current.columns]


def long_values(df: DataFrame, features: list[str], cast) -> DataFrame:
    """(feature, value) rows from one scan; an unpivot stays inside generated code."""
    return df.select(*[cast(F.col(c)).alias(c) for c in features]).unpivot([], features, "feature", "value")


def value_counts(baseline: DataFrame, current: DataFrame, features: list[str], cast) -> DataFrame:
    """Rows of each side per (feature, value). Features are counted by their place in the list, a number, and named afterwards."""
    def side(df: DataFrame, is_baseline: bool) -> DataFrame:
        values = df.select(F.posexplode(F.array(*[cast(F.col(c)) for c in features])).alias("place", "value"))
        return values.withColumn("is_baseline", F.lit(is_baseline))

    counts = (
        side(baseline, True)
        .unionByName(side(current, False))
        .groupBy("place", "value")
        .agg(
            F.count_if(F.col("is_baseline")).alias("baseline_n"),
            F.count_if(~F.col("is_baseline")).alias("current_n"),
        )
    )
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("place") + 1)
    return counts.select(name.alias("feature"), "value", "baseline_n", "current_n")


def numeric_counts(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    return value_counts(baseline, current, features, fn.lenient_double).where(fn.defined(F.col("value")))


def with_ranks(counts: DataFrame) -> DataFrame:
    """Adds the number of baseline rows below each value. The counts are stored, so every reader starts there."""
    return running_sums(counts, ["feature"], [F.col("value").asc()], {"baseline_before": F.col("baseline_n")})


def quantiles(ranked: DataFrame, parts: int) -> DataFrame:
    """(feature, part, edge): baseline quantiles part/parts for part = 0..parts, linearly interpolated.

    Quantile i of n sorted values lies between the positions low = (n-1)*i div parts and low + 1. A row
    covers the positions of its equal values, so the parts it can end are a short range known from its
    running count alone; almost every row ends none and is dropped at once.
    """
    sizes = ranked.groupBy("feature").agg(F.sum("baseline_n").alias("n")).where("n > 0")
    # sizes: one row per feature
    covering = ranked.where("baseline_n > 0").join(F.broadcast(sizes), "feature").selectExpr(
        "feature",
        "value",
        "n",
        "baseline_before as start",
        "baseline_before + baseline_n as stop",
        # least i with low >= start - 1, and greatest i with low < stop
        f"if(n = 1, 0, greatest(0, ((baseline_before - 1) * {parts} + n - 2) div (n - 1))) as first_part",
        f"if(n = 1, {parts}, least({parts}, ((baseline_before + baseline_n) * {parts} - 1) div (n - 1))) as last_part",
    )
    ended = covering.where("first_part <= last_part").select(
        "feature", "value", "n", "start", "stop",
        F.explode(F.sequence(F.col("first_part").cast("int"), F.col("last_part").cast("int"))).alias("part"),
    )
    placed = ended.withColumns({"low": F.expr(f"(n - 1) * part div {parts}"), "rest": F.expr(f"(n - 1) * part % {parts}")})

    def value_at(position: str):
        return F.max(F.when(F.expr(f"{position} >= start and {position} < stop"), F.col("value")))

    ends = placed.groupBy("feature", "part").agg(
        value_at("low").alias("low_value"), value_at("low + 1").alias("high_value"), F.max("rest").alias("rest")
    )
    step = (F.col("high_value") - F.col("low_value")) * (F.col("rest").cast("double") / F.lit(float(parts)))
    edge = F.when(F.col("rest") == 0, F.col("low_value")).otherwise(F.col("low_value") + step)
    return ends.select("feature", "part", edge.alias("edge"))


def bin_edges(ranked: DataFrame, bins: int = contract.PSI_BINS) -> DataFrame:
    """(feature, edges): the distinct baseline quantiles in order; at most bins + 1 of them."""
    return (
        quantiles(ranked, bins)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("edge")).alias("edges"))
    )


def histogram(ranked: DataFrame, edges: DataFrame, bins: int = contract.PSI_BINS) -> DataFrame:
    """(feature, bin, n_edges, baseline_n, current_n); bins are half open, the last one closed, outside dropped."""
    value, e = F.col("value"), F.col("edges")
    last = F.element_at(e, -1)
    reached = sum(
        (F.coalesce((F.get(e, F.lit(i)) <= value).cast("int"), F.lit(0)) for i in range(1, bins + 1)), F.lit(1)
    )
    position = F.least(reached, F.size(e) - 1)
    return (
        ranked.join(F.broadcast(edges.where(F.size("edges") >= 2)), "feature")
        .where((value >= e[0]) & (value <= last))
        .groupBy("feature", position.alias("bin"), F.size(e).alias("n_edges"))
        .agg(F.sum("baseline_n").alias("baseline_n"), F.sum("current_n").alias("current_n"))
    )


def numeric_drift(
    baseline: DataFrame,
    current: DataFrame,
    features: list[str],
    bins: int = contract.PSI_BINS,
    warning: float = contract.PSI_WARNING,
    alert: float = contract.PSI_ALERT,
) -> DataFrame:
    """(feature, psi, status) for every feature both sides have; psi is null where it is undefined."""
    features = shared_features(baseline, current, features)
    ranked = with_ranks(numeric_counts(baseline, current, features))
    return numeric_drift_of(ranked, features, bins, warning, alert)


def numeric_drift_of(
    ranked: DataFrame,
    features: list[str],
    bins: int = contract.PSI_BINS,
    warning: float = contract.PSI_WARNING,
    alert: float = contract.PSI_ALERT,
) -> DataFrame:
    sizes = ranked.groupBy("feature").agg(
        F.sum("baseline_n").alias("baseline_rows"), F.sum("current_n").alias("current_rows")
    )
    binned = histogram(ranked, bin_edges(ranked, bins), bins)
    # at most `bins` rows per feature: the shares need the in-range totals of both sides
    per_feature = Window.partitionBy("feature")

    def share(side: str):
        total = F.greatest(F.sum(side).over(per_feature), F.lit(1))
        return fn.clipped_share(F.col(side).cast("double") / total.cast("double"))

    shares = binned.select("feature", "n_edges", share("baseline_n").alias("e"), share("current_n").alias("a"))
    index = shares.groupBy("feature", "n_edges").agg(
        F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi")
    )
    names = ranked.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    defined = (
        (F.col("baseline_rows") >= bins)
        & (F.col("current_rows") >= contract.PSI_MIN_CURRENT_ROWS)
        & (F.col("n_edges") >= contract.PSI_MIN_EDGES)
    )
    psi = F.when(defined, F.col("psi"))
    return (
        names.join(sizes, "feature", "left")
        .join(index, "feature", "left")
        .select("feature", psi.alias("psi"), fn.band(psi, warning, alert).alias("status"))
    )


def category_shares(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, category, baseline_share, current_share, abs_diff) over the union of both sides."""
    features = shared_features(baseline, current, features)
    counts = value_counts(
        baseline, current, features, lambda c: F.coalesce(c.cast("string"), F.lit(contract.NULL_CATEGORY))
    )
    totals = counts.groupBy("feature").agg(
        F.sum("baseline_n").alias("baseline_rows"), F.sum("current_n").alias("current_rows")
    )

    def share(part: str, whole: str):
        return F.coalesce(fn.safe_divide(F.col(part), F.col(whole)), F.lit(0.0))

    # totals: one row per feature
    return (
        counts.join(F.broadcast(totals), "feature")
        .select(
            "feature",
            F.col("value").alias("category"),
            share("baseline_n", "baseline_rows").alias("baseline_share"),
            share("current_n", "current_rows").alias("current_share"),
        )
        .withColumn("abs_diff", F.abs(F.col("current_share") - F.col("baseline_share")))
    )


def top_shifts(shares: DataFrame, n: int = contract.TOP_SHIFTS) -> DataFrame:
    """The n largest share differences per feature, first category on a tie; ranked map-side first."""
    order = Window.partitionBy("feature").orderBy(F.col("abs_diff").desc(), F.col("category"))
    return shares.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def categorical_drift_of(
    shares: DataFrame, warning: float = contract.SHARE_WARNING, alert: float = contract.SHARE_ALERT
) -> DataFrame:
    """(feature, status, max_abs_share_diff, worst_category)."""
    worst = F.min(F.struct((-F.col("abs_diff")).alias("largest"), "category"))
    return (
        shares.groupBy("feature")
        .agg(F.max("abs_diff").alias("max_abs_share_diff"), worst["category"].alias("worst_category"))
        .select(
            "feature",
            fn.band(F.col("max_abs_share_diff"), warning, alert).alias("status"),
            "max_abs_share_diff",
            "worst_category",
        )
    )


def categorical_drift(
    baseline: DataFrame,
    current: DataFrame,
    features: list[str],
    warning: float = contract.SHARE_WARNING,
    alert: float = contract.SHARE_ALERT,
) -> DataFrame:
    return categorical_drift_of(category_shares(baseline, current, features), warning, alert)


def overall_status(*results: DataFrame) -> DataFrame:
    """Worst status over all features of all results, one row."""
    ranks = None
    for df in results:
        part = df.select(fn.severity(F.col("status")).alias("rank"))
        ranks = part if ranks is None else ranks.unionByName(part)
    return ranks.agg(
        fn.severity_name(F.coalesce(F.max("rank"), F.lit(0))).alias("overall_status")
    )


@dataclass(frozen=True)
class DriftReport:
    """The pieces of one drift run, each a small table."""

    numeric: DataFrame
    categorical: DataFrame
    shifts: DataFrame
    overall: DataFrame


def drift_report(
    baseline: DataFrame,
    current: DataFrame,
    numeric: list[str] = contract.NUMERIC_FEATURES,
    categorical: list[str] = contract.CATEGORICAL_FEATURES,
    bins: int = contract.PSI_BINS,
) -> DriftReport:
    # stored: both are read for the report and again for the overall status
    numbers = durable(numeric_drift(baseline, current, numeric, bins))
    shares = durable(category_shares(baseline, current, categorical))
    categories = categorical_drift_of(shares)
    return DriftReport(numbers, categories, top_shifts(shares), overall_status(numbers, categories))
