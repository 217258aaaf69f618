"""Session settings by the size of the data, and the shared checkpoint folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 128 * 1024 * 1024


def settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings for a run that shuffles about ``shuffled_bytes``.

    Adaptive execution merges small partitions and splits skewed ones, but it
    never makes more than it started with: the start must fit the data, or each
    partition grows past an executor's memory.
    """
    start = max(cores, math.ceil(shuffled_bytes / PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(start),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(start),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidebook-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share; Spark's end removes it."""
    folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Store a small frame that many consumers share in the checkpoint folder.

    Its inputs are read once, whatever the consumers, and an executor lost later
    does not bring that work back.
    """
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()
