"""A ledger tier laid out by id, so that a lookup reads the files of the ids asked for and no others."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "id_bucket"


def _bucket(an_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(an_id), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class LedgerIndex:
    """A folder per hash of the id; rows are sorted by id within their files.

    The number of folders is for the writer to choose by the ledger's size: a lookup
    reads at most one folder per id, and of its files the row groups whose
    statistics can hold the id.
    """

    path: str
    buckets: int
    schema: T.StructType

    def rows(self, spark: SparkSession, ids: Iterable[str]) -> DataFrame:
        wanted = sorted({i for i in ids if i is not None})
        whole = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        table = spark.read.schema(whole).parquet(self.path)
        if not wanted:
            return table.filter("false").drop(BUCKET)
        # Constants for the optimizer, so folders are pruned when the plan is made.
        folders = F.col(BUCKET).isin(*[_bucket(F.lit(i), self.buckets) for i in wanted])
        return table.filter(folders & F.col("transaction_id").isin(wanted)).drop(BUCKET)


def write_index(ledger: DataFrame, path: str, buckets: int) -> LedgerIndex:
    """One shuffle of the ledger by bucket; a hot bucket is split over several files."""
    keyed = ledger.withColumn(BUCKET, _bucket(F.col("transaction_id"), buckets))
    laid_out = keyed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "transaction_id")
    laid_out.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
    return LedgerIndex(path, buckets, ledger.schema)
