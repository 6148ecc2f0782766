"""Time-based dataset splits and label balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.functions import columns as fn

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def cut(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def labelled(features: DataFrame, label: str) -> DataFrame:
    return features.where(F.col(label).isNotNull())


def with_split(df: DataFrame, time: str, validation_start: str, test_start: str) -> DataFrame:
    """Adds the split name; ranges are half open: train < validation_start <= validation < test_start <= test.

    A row without a time belongs to no split.
    """
    at = F.col(time)
    return df.withColumn(
        "split",
        F.when(at < cut(validation_start), TRAIN).when(at < cut(test_start), VALIDATION).when(at.isNotNull(), TEST),
    ).where(F.col("split").isNotNull())


def extended_split(df: DataFrame, time: str, extended_end: str, test_start: str) -> DataFrame:
    """Longer training range before an unchanged test range."""
    if not extended_end < test_start:
        raise ValueError(f"extended training end {extended_end} must be before test start {test_start}")
    return with_split(df, time, extended_end, test_start)


def split_sizes(split: DataFrame) -> DataFrame:
    """(split, n_rows), one row for each of the three splits, also for an empty one."""
    names = split.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in (TRAIN, VALIDATION, TEST)])).alias("split")
    )
    counts = split.groupBy("split").agg(F.count("*").alias("n_rows"))
    return names.join(counts, "split", "left").select("split", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def require_splits(split: DataFrame, names: tuple[str, ...] = (TRAIN, VALIDATION, TEST)) -> dict[str, int]:
    """Split sizes as numbers (three rows); an empty required split is an error."""
    sizes = {row["split"]: row["n_rows"] for row in split_sizes(split).collect()}
    empty = [name for name in names if not sizes[name]]
    if empty:
        raise ValueError(f"empty split: {', '.join(empty)}; check the time range of the features")
    return sizes


def class_balance(split: DataFrame, label: str) -> DataFrame:
    """(split, label, n_rows, percent of the split)."""
    counts = split.groupBy("split", label).agg(F.count("*").alias("n_rows"))
    totals = counts.groupBy("split").agg(F.sum("n_rows").alias("split_rows"))
    return counts.join(F.broadcast(totals), "split").select(
        "split", label, "n_rows", fn.safe_divide(F.col("n_rows") * F.lit(100), F.col("split_rows")).alias("percent")
    )
