"""Helpers shared by the operators: whole texts in Arrow batches, gapless numbers, query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space between words, the six characters that split bytes in Python.
SPACE = r"[\x20\x09-\x0D]"
# Rows of a group that share a number bucket are ranked by one task; more buckets mean smaller tasks.
BUCKETS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column; nothing is decoded, so odd bytes do no harm."""
    return column.cast(pa.binary()).to_pylist()


def portions(batches: Iterator[pa.RecordBatch], text: str | int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of about ``size`` bytes of text, so that what is made of one stays small."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(1, batch.column(text).nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, pa.Array] | pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch; a dictionary of columns becomes a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            yield pa.RecordBatch.from_pydict(made) if isinstance(made, dict) else made

    return df.mapInArrow(run, schema)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of the keys in which null equals null."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def gapless(df: DataFrame, group: str, order: list[Column], out: str, buckets: int = BUCKETS, few_groups: bool = False) -> DataFrame:
    """Numbers the rows of each group 0, 1, 2, ... without bringing a group together.

    Rows go to buckets by a hash of ``order``, which should tell rows of a group apart; a bucket's rows are ranked
    in one task, and a window over the bucket sizes, at most ``buckets`` rows per group, says where each bucket begins.
    ``df`` is read twice, so it should be a stored table. A null group is a group. With ``few_groups`` the caller vouches
    for a small number of groups, and the bucket table, ``buckets`` rows of each, is broadcast.
    """
    tagged = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
        .select(F.col(group).alias("_group"), F.col("_bucket").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = tagged.withColumn("_rank", F.row_number().over(within) - 1)
    if few_groups:
        starts = F.broadcast(starts)
    return (
        ranked.join(starts, ranked[group].eqNullSafe(F.col("_group")) & (ranked["_bucket"] == F.col("_at")))
        .withColumn(out, (F.col("_start") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_start", "_group", "_at")
    )
