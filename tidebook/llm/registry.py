"""The subpackage's queries over the tables of one folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidebook.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    html_main,
    langid,
    near_dedup,
    packing,
    periodic_runs,
    secrets,
    slack_packing,
    statements,
    substring_dedup,
    suffix_dedup,
    warc,
)
from tidebook.llm.common import scratch, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = near_dedup.near_dedup(docs, width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.RatioModel.fit(secrets.labelled_samples(spark, docs))
    found = secrets.find_secrets(docs, model).select("doc_id", F.col("found.spans").alias("spans"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path(packing.TOKENIZER))
    return packing.pack(pieces)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = docs.withColumn("text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    return exact_dedup.exact_dedup(hashed).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return html_main.extract(pages).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pieces = langid.read_vocabulary(public_tokenizers.path(langid.VOCABULARY))
    model = langid.train(docs.filter(langid.fold("doc_id") != 2), pieces, pick=F.xxhash64("doc_id"))
    judged = langid.identify(docs, model)
    return judged.select("doc_id", (langid.fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return warc.read_warc(manifest).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def runs_as_rows(found: DataFrame) -> DataFrame:
    best = F.col("runs.strongest")
    return found.select(
        "doc_id",
        F.size("runs.spans").cast("long").alias("n_runs"),
        *(best[c].alias(c) for c in ("start", "length", "period", "exponent_milli")),
        "runs.runs_sha256",
        "runs.collapsed_sha256",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs_as_rows(periodic_runs.find_runs(docs, seed=periodic_runs.cycle_seed("doc_id")))


def op13_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = slack_packing.token_pieces(docs, public_tokenizers.path(slack_packing.TOKENIZER))
    return slack_packing.pack(pieces)


QUERIES = (
    op1_suffix_dedup,
    op2_decontamination,
    op3_near_dedup,
    op4_secrets,
    op5_packing,
    op6_exact_dedup,
    op7_html_extraction,
    op8_substring_dedup,
    op9_language_id,
    op10_warc,
    op11_source_divergence,
    op12_periodic_runs,
    op13_slack_packing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return statements.STATEMENTS | pipeline
