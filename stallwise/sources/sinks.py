"""Writes. All go through Spark's committers straight from the executors.

A replaceable table is a folder with one sub-folder per version and a log of small files, one per replacement, each naming
the version it made current. A replacement writes its version aside and then adds the next log file, which only one writer
can: until then, or if the job fails, readers see the version before. The version before the current one is kept for
readers in flight; older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.session import CODEC

LOG = "_log"
VERSIONS_KEPT = 2


class ReplacedMeanwhile(RuntimeError):
    """Another writer replaced the table after this one read it."""


def _folder(spark: SparkSession, path: str):
    """The file system that owns ``path``, and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _log(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version folder) of the replacements in order; a log file without its name yet is no replacement."""
    files, make = _folder(spark, path)
    place = make(f"{path.rstrip('/')}/{LOG}")
    if not files.exists(place):
        return []
    found = []
    for entry in files.listStatus(place):
        name = entry.getPath().getName()
        if name.isdigit() and entry.getLen() > 0:
            stream = files.open(entry.getPath())
            try:
                found.append((int(name), stream.readUTF()))
            finally:
                stream.close()
    return sorted(found)


def revision(spark: SparkSession, path: str) -> int:
    """Number of the newest replacement, 0 before the first one."""
    return max((number for number, _ in _log(spark, path)), default=0)


def location(spark: SparkSession, path: str) -> str:
    """The folder with the current rows; the path itself for a table that was never written here."""
    log = _log(spark, path)
    return f"{path.rstrip('/')}/{log[-1][1]}" if log else path


def table(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the current version. It goes on reading that version while the table is replaced."""
    return spark.read.parquet(location(spark, path))


def overwrite(df: DataFrame, path: str, expected: int | None = None) -> DataFrame:
    """Create or replace a Parquet table and return it as a scan of the new version.

    With ``expected`` the replacement holds only if the table is still at that revision; else it raises
    ``ReplacedMeanwhile`` and changes nothing.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = revision(spark, path) if expected is None else expected
    version = f"version-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(f"{base}/{version}")
    files, make = _folder(spark, path)
    number = before
    while True:
        number += 1
        try:
            stream = files.create(make(f"{base}/{LOG}/{number:012d}"), False)
            break
        except Exception as error:
            if "FileAlreadyExists" not in str(error) and "already exists" not in str(error):
                raise
            if expected is not None:
                files.delete(make(f"{base}/{version}"), True)
                raise ReplacedMeanwhile(f"{path} is past revision {expected}: another run replaced it") from None
    stream.writeUTF(version)
    stream.close()
    for old, folder in _log(spark, path)[:-VERSIONS_KEPT]:
        files.delete(make(f"{base}/{folder}"), True)
        files.delete(make(f"{base}/{LOG}/{old:012d}"), False)
    return spark.read.schema(df.schema).parquet(f"{base}/{version}")


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """A plain folder for rows that are written once under a name of their own, such as a model's training rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, path: str | None) -> DataFrame:
    """A stored layer when a path is given, a lazy one otherwise."""
    return df if path is None else overwrite(df, path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Replaces only the (version, day) partitions contained in ``predictions``."""
    (
        predictions.withColumn("run_date", F.to_date("prediction_timestamp"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version", "run_date")
        .parquet(path)
    )


def read_predictions(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Predictions of one version (a partition filter) or of all."""
    # partition values are text: without this a version such as "2" would come back as a number
    scan = spark.read.schema(
        "order_id string, predicted_probability double, predicted_class int, prediction_timestamp timestamp,"
        " model_version string, run_date date"
    ).parquet(path)
    return scan if version is None else scan.where(F.col("model_version") == F.lit(version))


def append_report(report: DataFrame, path: str) -> None:
    """Adds one monitoring run to the reports table."""
    report.write.mode("append").parquet(path)


def latest_report(reports: DataFrame) -> DataFrame:
    """The newest run: one row, reduced map-side."""
    return reports.agg(
        F.max("run_at").alias("run_at"), F.max_by("report_json", "run_at").alias("report_json")
    ).where(F.col("run_at").isNotNull())
