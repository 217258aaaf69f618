"""Unreadable values set apart, so that one of them does not end a run.

A feed is read as text. Every declared column is cast with ``try_cast``; a text that
is there and cannot be read makes a reject row that names record, column, text and
reason, and its record is kept out of the typed rows. Lines with the wrong number of
fields are rejects as a whole. Blank text is no value, as in a strict read.

Both sides are projections of the same text, without a shuffle: a feed costs one
more scan where its rejects are asked for too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions import text_literal

LINE = "_line"
WRONG_FIELDS = "wrong number of fields"
REJECT_COLUMNS = ("feed", "record_id", "column_name", "raw_value", "reason")
DAY = r"^\\d{4}-\\d{2}-\\d{2}$"


@dataclass(frozen=True)
class Split:
    """``valid`` has the declared columns; ``rejects`` one row per unreadable value."""

    valid: DataFrame
    rejects: DataFrame


def read_text_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with the declared columns as text, and the line where fields are missing or left over.

    A wrong header fails the read, as it concerns every record.
    """
    names = T.StructType.fromDDL(schema).names
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])
    return (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)  # a line is judged by all its fields, whatever is asked for
        .csv(path)
    )


def _typed(name: str, kind: T.DataType) -> str:
    """SQL for the value of a text column, NULL where it cannot be read."""
    text = f"nullif(trim(`{name}`), '')"
    if isinstance(kind, T.StringType):
        return f"`{name}`"
    if isinstance(kind, T.DateType):
        # A cast alone would also take '2026' and '2026-1-5 noon'.
        return f"if({text} RLIKE '{DAY}', try_cast({text} AS DATE), NULL)"
    return f"try_cast({text} AS {kind.simpleString()})"


def split_readable(raw: DataFrame, schema: str, feed: str, record_id: str) -> Split:
    """``raw`` has the declared columns as text, and may have the whole line as ``_line``.

    ``record_id`` is an expression over the text; other columns of ``raw`` stay with
    the valid rows.
    """
    fields = T.StructType.fromDDL(schema).fields
    problems = [
        f"if(nullif(trim(`{f.name}`), '') IS NOT NULL AND {_typed(f.name, f.dataType)} IS NULL, "
        f"struct({text_literal(f.name)} AS column_name, `{f.name}` AS raw_value, "
        f"{text_literal('not ' + f.dataType.simpleString())} AS reason), NULL)"
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    found = f"filter(array({', '.join(problems)}), p -> p IS NOT NULL)" if problems else "array()"
    if LINE in raw.columns:
        whole = f"struct('{LINE}' AS column_name, {LINE} AS raw_value, '{WRONG_FIELDS}' AS reason)"
        found = f"if({LINE} IS NOT NULL, array({whole}), {found})"
    judged = raw.withColumn("_problems", F.expr(found))
    declared = {f.name for f in fields}
    others = [f"`{c}`" for c in raw.columns if c not in declared and c != LINE]
    valid = judged.filter(F.size("_problems") == 0).selectExpr(
        *[f"{_typed(f.name, f.dataType)} AS `{f.name}`" for f in fields], *others
    )
    rejects = judged.filter(F.size("_problems") > 0).selectExpr(
        f"{text_literal(feed)} AS feed", f"CAST({record_id} AS STRING) AS record_id", "inline(_problems)"
    )
    return Split(valid, rejects)


def all_rejects(*splits: Split) -> DataFrame:
    return reduce(DataFrame.unionByName, [s.rejects for s in splits])


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected records and values by feed, column and reason."""
    return rejects.groupBy("feed", "column_name", "reason").agg(
        F.count("*").alias("n_values"), F.countDistinct("record_id").alias("n_records")
    )
