"""The registered queries over the sample tables, against their SQL where there is one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tidebook.llm import registry

COLUMNS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op7_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op11_source_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_slack_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


def test_all_are_registered():
    assert set(COLUMNS) | {"pipeline"} == set(registry.queries()) <= set(entry.queries())
    assert set(registry.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equal_to_sql(spark, sf_dir, name):
    assert difference(registry.queries()[name](spark, sf_dir), connect(sf_dir), registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_whole_tables(spark, sf_dir, name):
    frame = registry.queries()[name](spark, sf_dir)
    assert frame.columns == COLUMNS[name]
    if name == "op11_source_divergence":
        asked = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source")
        assert frame.filter("part = 'pair'").select("lang", "source").distinct().count() == asked.distinct().count()
        return
    table, key = ("pages", "page_id") if "page_id" in frame.columns else ("documents", "doc_id")
    asked = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    assert frame.select(key).distinct().exceptAll(asked).count() == asked.exceptAll(frame.select(key).distinct()).count() == 0
