"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength()


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with declared columns. A bad value or a wrong header fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def write_table(frame: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write Parquet and return the written table.

    Rows are rebalanced on the partition columns first: a large month is split
    over several tasks, small ones share a task, and the number of files stays
    near the data volume over the advisory partition size.
    """
    schema = frame.schema
    if partition_by:
        frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
    frame.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def write_csv(
    frame: DataFrame, path: str, *order_by: str, single_file: bool = False, parts: int | None = None
) -> None:
    """Header CSV in the given order; part files follow each other in that order.

    ``single_file`` is for outputs known to be small; ``parts`` deals the ranges of the
    order to about that many files, which a sort alone leaves to adaptive execution.
    """
    if parts:
        ordered = frame.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    else:
        ordered = frame.orderBy(*order_by)
    if single_file:
        ordered = ordered.coalesce(1)
    texts = [
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, T.DateType)
        else F.col(f.name)
        for f in frame.schema
    ]
    ordered.select(*texts).write.mode("errorifexists").option("header", True).csv(path)


FILE, BLOCK, ROW = "_file", "_block", "_row"


def read_csv_placed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As ``read_csv``, with where each row stands: number of its part file, start of its split, place in that.

    A task reads its split from front to back, and Spark numbers its rows in that order.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    return read_csv(spark, path, schema).select(
        "*",
        part.alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def file_order(placed: DataFrame, *order_by: str) -> DataFrame:
    """The rows with their ``rank`` over all part files, and whether each follows the one before in order.

    Rows are numbered within their split; splits have few rows among them (how many
    rows, first and last key), which are put in order to know what each starts at. So
    no task sees more than one split of rows.
    """
    split = [FILE, BLOCK]
    key = F.struct(*order_by)
    within = Window.partitionBy(*split).orderBy(ROW)
    numbered = placed.withColumn("_n", F.row_number().over(within)).withColumn("_before", F.lag(key).over(within))
    splits = numbered.groupBy(*split).agg(F.count("*").alias("_rows"), F.max_by(key, ROW).alias("_last"))
    along = Window.orderBy(*split)
    splits = splits.select(
        *split,
        (F.sum("_rows").over(along) - F.col("_rows")).alias("_start"),
        F.lag("_last").over(along).alias("_left"),
    )
    joined = numbered.join(splits, split)
    before = F.when(F.col("_n") == 1, F.col("_left")).otherwise(F.col("_before"))
    return joined.select(
        *[c for c in placed.columns if c not in (FILE, BLOCK, ROW)],
        (F.col("_start") + F.col("_n")).alias("rank"),
        F.coalesce(before <= key, F.lit(True)).alias("in_order"),
    )
