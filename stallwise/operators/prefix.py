"""Running sums over sorted groups of any size.

A window over a whole group would send it to one task. Instead all rows are cut into ordered slices, the range
partitions over (group, order), which split any group, including one in which every row has the same time:

1. totals per (group, slice), combined map-side;
2. a window over those totals gives the sum before each slice: per group one row per slice it touches;
3. each slice receives its starting sum as an extra leading row, and a window inside (group, slice)
   adds up the rows.

Rows are stored once before they are cut and once with their slice; totals and details read the latter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.session import durable

SLICE = "_slice"
LEADING = "_leading"
PREVIOUS = "_previous_"


def range_sliced(df: DataFrame, keys: list[Column], slices: int | None = None, stored: bool = False) -> DataFrame:
    """Adds the number of the range partition over ``keys``; numbers follow the order of the keys.

    As many slices as the session has shuffle partitions, which grow with the data. The rows are stored first,
    because the bounds come from a sample that reads them too, and again with their numbers: a task that runs
    again must not see other bounds. ``stored``: the rows are a scan of a stored table and need no copy of their own.
    """
    number = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df if stored else durable(df)).repartitionByRange(number, *keys)
    return durable(ranged.withColumn(SLICE, F.spark_partition_id()))


def running_sums(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column], stored: bool = False) -> DataFrame:
    """Adds, per output name, the sum of an expression over the earlier rows of the group.

    The current row is excluded; the sum of no rows is 0. ``order`` has to be a total order within a
    group. Meant for reduced or narrow rows.
    """
    sliced = range_sliced(df, [*[F.col(g) for g in group], *order], stored=stored)
    return summed_by_slice(sliced, slice_totals(sliced, group, sums), group, order, sums)


def slice_totals(sliced: DataFrame, group: list[str], sums: dict[str, Column]) -> DataFrame:
    return sliced.groupBy(*group, SLICE).agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(PREVIOUS + name) for name, value in sums.items()]
    )


def summed_by_slice(
    sliced: DataFrame, totals: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]
) -> DataFrame:
    keys = [F.col(g) for g in group]
    before_slice = (
        Window.partitionBy(*(keys or [F.lit(1)]))
        .orderBy(F.col(SLICE).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.select(
        *group,
        SLICE,
        F.lit(True).alias(LEADING),
        *[F.coalesce(F.sum(PREVIOUS + n).over(before_slice), F.lit(0)).alias(PREVIOUS + n) for n in sums],
    )
    details = sliced.select(
        "*", F.lit(False).alias(LEADING), *[F.coalesce(v, F.lit(0)).alias(PREVIOUS + n) for n, v in sums.items()]
    )
    before_row = (
        Window.partitionBy(*keys, F.col(SLICE))
        .orderBy(F.col(LEADING).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        details.unionByName(starts, allowMissingColumns=True)
        .withColumns({n: F.sum(PREVIOUS + n).over(before_row) for n in sums})
        .where(~F.col(LEADING))
        .drop(SLICE, LEADING, *[PREVIOUS + n for n in sums])
    )


def running_mean_before(df: DataFrame, group: str, order: list[Column], value: str, out: str, stored: bool = False) -> DataFrame:
    """Mean of ``value`` over the earlier rows of the group; nulls are skipped, null before the first value.

    Rows whose group is null form one group.
    """
    added = running_sums(
        df, [group], order, {"_value_sum": F.col(value), "_value_n": F.col(value).isNotNull().cast("bigint")}, stored
    )
    return added.withColumn(
        out, F.try_divide(F.col("_value_sum").cast("double"), F.col("_value_n").cast("double"))
    ).drop("_value_sum", "_value_n")
