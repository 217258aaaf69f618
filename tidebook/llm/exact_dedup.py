"""Exact duplicates by progressive refinement: length, then a prefix's hash, then the full hash.

Two texts are equal when they are the same after every run of white space has
become one blank. Each step reads on only for the rows whose group still has a
second member:

1. Rows are counted by length; rows alike in length and prefix are one row there.
2. Of a length that occurs twice, the prefixes whose hash occurs twice go on.
3. The full hash is taken only of rows whose length and prefix occur twice;
   rows are then grouped by it.

The survivors of step 2 are handed to step 3 as a bitmap of ``2**23`` bits (1 MB,
whatever the input), so that no text is shuffled to find them. A bit that two
prefixes share lets a row through that step 3 then finds alone; the result is
the same. All of it is DataFrame work. Every grouping has a partial phase and
the last join carries hashes beside the other columns, so a text that a third of
all rows share is one partial row per task, and a join partition that adaptive
execution splits.

Defined cases: a null text counts as empty; empty texts are equal to each other.
Rows that repeat a doc_id and its text share one decision, so all of them are
kept or none. A null doc_id never wins against another id; where a group has no
other, its rows are all kept. Texts may be of any length: they are hashed where they
are read, and only lengths and hashes move. An empty table gives an empty result.
Columns of the input stay; ones named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import stored

PREFIX = 256
MARKS = 1 << 23
RESULT = ("keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    """Runs of white space as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _marks(heads: DataFrame) -> DataFrame:
    """Bit maps of the surviving heads, at most 256 rows of 4 KB."""
    place = F.pmod("__head", F.lit(MARKS))
    return heads.groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX
) -> DataFrame:
    """The rows with ``keep_id``, ``group_size`` and ``kept``."""
    docs = docs.drop(*(c for c in RESULT if c != id_col and c != text_col))
    norm = normalised(F.col(text_col))
    length = F.length(norm)
    head = F.xxhash64(length, F.substring(norm, 1, prefix))
    keys = docs.groupBy(length.alias("__length"), head.alias("__head")).agg(F.count("*").alias("__rows"))
    keys = stored(keys, "dedup-keys")
    lengths = keys.groupBy("__length").agg(F.sum("__rows").alias("__all")).filter("__all > 1")
    heads = keys.filter("__rows > 1").join(lengths, "__length", "left_semi")
    marks = F.broadcast(stored(_marks(heads), "dedup-marks"))

    place = F.pmod("__head", F.lit(MARKS))
    held = F.conv(F.hex(F.substring("__bits", (F.col("__at") / 8 + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", held.cast("int"), (F.col("__at") % 8).cast("int")) % 2
    rows = (
        docs.withColumn("__head", head)
        .withColumn("__bucket", F.bitmap_bucket_number(place))
        .join(marks, "__bucket", "left")
        .withColumn("__at", F.bitmap_bit_position(place))
        .withColumn("__suspect", F.coalesce(bit == 1, F.lit(False)))
    )
    alone = rows.filter("NOT __suspect").select(
        *docs.columns,
        F.col(id_col).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    hashed = rows.filter("__suspect").withColumn("__full", F.sha2(norm, 256))
    groups = hashed.groupBy("__full").agg(
        F.min(id_col).alias("keep_id"), F.count("*").alias("group_size")
    )
    grouped = hashed.join(groups, "__full").select(
        *docs.columns, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept")
    )
    return alone.unionByName(grouped)
