"""Replaceable tables: readers keep what they read, failed and late writers change nothing."""

import os

import pytest
from pyspark.sql import functions as F

from stallwise.plans import runs
from stallwise.session import fresh_path
from stallwise.sources import sinks


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_failed_write_keeps_the_old_table(spark):
    path = fresh_path(spark, "table")
    sinks.overwrite(spark.range(5), path)
    broken = spark.range(100, 200).repartition(4).select(F.when(F.col("id") == 150, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.overwrite(broken, path)
    assert ids(sinks.table(spark, path)) == [0, 1, 2, 3, 4] and sinks.revision(spark, path) == 1


def test_reader_in_flight_and_its_own_replacement(spark):
    path = fresh_path(spark, "table")
    old = sinks.overwrite(spark.range(5), path)
    new = sinks.overwrite(old.select((F.col("id") + 10).alias("id")), path)
    assert ids(old) == [0, 1, 2, 3, 4]
    assert ids(new) == ids(sinks.table(spark, path)) == [10, 11, 12, 13, 14]
    sinks.overwrite(new.where("id > 12"), path)
    assert ids(sinks.table(spark, path)) == [13, 14] and ids(new) == [10, 11, 12, 13, 14]
    assert sum(name.startswith("version-") for name in os.listdir(path)) == sinks.VERSIONS_KEPT


def test_late_writer_fails_with_a_message(spark):
    path = fresh_path(spark, "table")
    sinks.overwrite(spark.range(1), path)
    seen = sinks.revision(spark, path)
    sinks.overwrite(spark.range(2), path, expected=seen)
    with pytest.raises(sinks.ReplacedMeanwhile, match="another run"):
        sinks.overwrite(spark.range(3), path, expected=seen)
    assert ids(sinks.table(spark, path)) == [0, 1]
    assert sum(name.startswith("version-") for name in os.listdir(path)) == 2


def test_plain_folder_is_a_table(spark):
    path = fresh_path(spark, "plain")
    spark.range(3).write.parquet(path)
    assert sinks.location(spark, path) == path and ids(sinks.table(spark, path)) == [0, 1, 2]
    assert ids(sinks.overwrite(spark.range(4), path)) == ids(sinks.table(spark, path)) == [0, 1, 2, 3]


def test_two_runs_from_one_registry_state(spark):
    path = fresh_path(spark, "registry")
    empty = spark.createDataFrame([], "version string, path string")
    first = spark.createDataFrame([("v1", "m/run-a/v1")], empty.schema)
    active, revision = runs.registry_state(spark, path, empty)
    assert active.count() == 0 and revision == 0
    runs.register(first, path, revision)
    active, revision = runs.registry_state(spark, path, empty)
    assert active.first()["version"] == "v1"
    runs.register(spark.createDataFrame([("v2", "m/run-b/v2")], empty.schema), path, revision)
    with pytest.raises(sinks.ReplacedMeanwhile):
        runs.register(spark.createDataFrame([("v2", "m/run-c/v2")], empty.schema), path, revision)
    assert runs.registry_state(spark, path, empty)[0].first()["path"] == "m/run-b/v2"
    assert sinks.table(spark, path).count() == 2
