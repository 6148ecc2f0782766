"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Sizes (executors, memory, shuffle partitions) belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys (a popular seller, product or customer) are split at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # dated prediction partitions are replaced one by one
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local
    folder would lose data with the machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="stallwise-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses.

    All paths of one application share one folder, which may be deleted when the application has ended.
    """
    application = f"stallwise-{spark.sparkContext.applicationId}"
    return f"{shared_dir(spark).rstrip('/')}/{application}/{name}-{uuid.uuid4().hex}"


# Steps and layers are written once and read a few times: the denser codec saves disk and network.
CODEC = "zstd"

# Shuffle files of a written step are of no more use.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Used where a value must not change when a task is run again (range-partition numbers), and where
    one aggregate feeds several later steps. A lost executor costs nothing already written, and readers
    take only the columns they need. The shuffle files of the write go as it ends.
    """
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", CODEC).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.step_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a step that nothing reads any more: all that was made from it is written."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.step_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
