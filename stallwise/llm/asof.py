"""The latest earlier source row of the same key, for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.operators.prefix import SLICE, range_sliced


def latest_earlier(rows: DataFrame, key: str, order: list[str], is_source: Column, taken: list[str], out: str) -> DataFrame:
    """Adds ``out``: the columns ``taken`` of the latest source row that lies before the row in ``order``, or null.

    Rows are cut into ranges of (key, order). Within a range a window looks back; what came before it is one value per
    key and range, carried on by a window over these. A row whose key is null has none. ``order`` should be a
    total order within a key.
    """
    sliced = range_sliced(rows.withColumn("_taken", F.when(is_source, F.struct(*taken))), [F.col(key), *[F.col(c) for c in order]])
    before = Window.partitionBy(SLICE, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = sliced.where(F.col("_taken").isNotNull() & F.col(key).isNotNull()).groupBy(key, SLICE).agg(F.max_by("_taken", F.struct(*order)).alias("_last"))
    touched = sliced.where(F.col(key).isNotNull()).groupBy(key, SLICE).agg(F.lit(1).alias("_one")).drop("_one")
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    # rows only for keys that go on from one slice to the next, so no more than slices
    starts = touched.join(last, [key, SLICE], "left").withColumn("_carried", carried).where(F.col("_carried").isNotNull()).select(F.col(key).alias("_key"), F.col(SLICE).alias("_at"), "_carried")
    within = F.when(F.col(key).isNotNull(), F.last("_taken", ignorenulls=True).over(before))
    return (
        sliced.withColumn("_within", within)
        .join(starts, (F.col(key) == F.col("_key")) & (F.col(SLICE) == F.col("_at")), "left")
        .withColumn(out, F.coalesce("_within", "_carried"))
        .drop(SLICE, "_taken", "_within", "_key", "_at", "_carried")
    )
