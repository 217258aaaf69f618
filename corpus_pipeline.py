"""A training corpus from raw documents: five stages, each written before the next reads it.

``STAGES`` lists them in order. A stage takes (spark, docs, sf_dir) and works on all
that its predecessor kept; all but the last return the columns of ``docs``.

Defined cases: an empty table passes through every stage. Documents without letters
(null and empty ones among them) go at the first stage. Rows that repeat a doc_id
and a text share every decision. A row with a null doc_id is never dropped as a near
duplicate, because no id says which of them is meant; as an exact copy it is.
Columns that the operators add are gone again when a stage returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import common, decontaminate, exact_dedup, langid, near_dedup, packing

#: A document stays when its language takes at least this share among all.
MIN_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters or no clear language."""
    pieces = langid.read_vocabulary(public_tokenizers.path(langid.VOCABULARY))
    model = langid.train(docs.filter(langid.fold("doc_id") != 2), pieces, pick=F.xxhash64("doc_id"))
    judged = langid.identify(docs.withColumn("__row", F.struct(*docs.columns)), model)
    clear = (F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_SCORE)
    return judged.filter(clear).select("__row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each equal text."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    return exact_dedup.exact_dedup(rows).filter("kept").select("__row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    found = near_dedup.near_dedup(docs)
    dropped = common.stored(found.filter("NOT kept").select("doc_id", "text_hash").distinct(), "near-copies")
    dropped = dropped.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(dropped, same, "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have a passage of the benchmark."""
    rows = docs.select("text", F.struct(*docs.columns).alias("__row"))
    found = decontaminate.decontaminate(rows, common.table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hits") == 0).select("__row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document is in the training sequences."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(packing.TOKENIZER)))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language models and the tokenizer are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
