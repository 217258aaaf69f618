"""Lookups by id read what can hold the ids, and no more."""

from __future__ import annotations

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidebook.operators import ledger, lineage, lookup
from tidebook.sources import trade
from tidebook.sources.ids import IdFormat, literal_ids

PAIR = IdFormat("X", (("a", "bigint"), ("b", "int")))


def test_ids_and_back():
    assert PAIR.parse("X-12--3") == (12, -3) and PAIR.parse("X-0-0") == (0, 0)
    for text in ("X-1", "X-1-2-3", "Y-1-2", "X-01-2", "X-1-2 ", "x-1-2", "X-1-+2", "X-1-99999999999", "", "X-é-2", "X-١-2"):
        assert PAIR.parse(text) is None
    assert IdFormat("", (("name", "string"),)).parse("any-thing") == ("any-thing",)
    assert IdFormat("P", (("a", "string"), ("b", "int"))).parse("P-x-y-7") == ("x-y", 7)


def test_predicate_is_equality_with_the_id(spark):
    rows = spark.createDataFrame([(a, b) for a in (1, 2, 3, None) for b in (1, 2, None)], "a bigint, b int")
    for asked in (["X-1-1"], ["X-1-2", "X-2-1"], ["X-9-9", "junk"], [], [None, "X-3-2"]):
        found = rows.filter(PAIR.predicate(asked)).selectExpr(f"{PAIR.expression()} AS id").collect()
        every = rows.selectExpr(f"{PAIR.expression()} AS id").collect()
        assert sorted(r.id for r in found) == sorted(r.id for r in every if r.id is not None and r.id in asked)


def test_literal_ids_stop_at_their_limit(spark):
    ids = spark.range(5).selectExpr("concat('a', id % 3) AS transaction_id").unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS transaction_id")
    )
    assert literal_ids(ids, 3) == ["a0", "a1", "a2"] and literal_ids(ids, 2) is None


def pushed(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PushedFilters: (.*)", plan)


def test_keys_of_asked_ids_reach_the_scans(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    book = entry.book_of(spark, sf_dir)
    chosen, closed = lineage.records_of_ids(book.extracts, book.mapping, entry.SCENARIO, entry.asked_ids(book))
    for extract, key in zip(chosen, ("o_orderkey", "l_orderkey")):
        assert any(f"In({key}, [" in filters or f"EqualTo({key}" in filters for filters in pushed(extract.records()))
    text = " ".join(pushed(closed))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "In(o_orderkey, [" in text and "In(l_orderkey, [" in text and "In(l_linenumber, [" in text


def test_selected_trace_is_the_whole_trace_cut_down(spark, sf_dir, monkeypatch):
    book = entry.book_of(spark, sf_dir)
    ids = entry.asked_ids(book)
    whole = lineage.trace(book.extracts, book.mapping, book.actuals, book.lines)
    wanted = sorted(whole.join(ids.select("transaction_id").distinct(), "transaction_id", "left_semi").select(*whole.columns).collect(), key=repr)
    for limit in (1_000, 3):  # as literals, and joined
        monkeypatch.setattr(lineage, "literal_ids", lambda frame, n=limit: literal_ids(frame, n))
        got = lineage.trace_selected(book.extracts, book.mapping, entry.SCENARIO, book.lines, ids)
        assert sorted(got.collect(), key=repr) == wanted


def files_read(frame):
    """Files that the scans of an executed plan have opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_index_reads_the_folders_of_the_ids(spark, sf_dir, tmp_path):
    book = entry.book_of(spark, sf_dir)
    index = lookup.write_index(book.full_ledger, str(tmp_path / "by_id"), buckets=16)
    whole = spark.read.parquet(index.path)
    assert files_read(whole) >= 16
    one = whole.filter("transaction_id IS NOT NULL").first().transaction_id
    found = index.rows(spark, [one, "no such id", None])
    assert 1 <= files_read(found) <= 4
    rows = book.full_ledger.filter(F.col("transaction_id") == one)
    assert sorted(found.collect()) == sorted(rows.collect())
    assert index.rows(spark, []).collect() == [] and found.columns == rows.columns


def test_null_and_repeated_ids_in_the_index(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3)], "transaction_id string, x int")
    index = lookup.write_index(rows, str(tmp_path / "i"), buckets=3)
    assert sorted(index.rows(spark, ["a", "zz"]).collect()) == [("a", 1), ("a", 1)]


@pytest.mark.parametrize("asked", [["x-1"], []])
def test_extract_without_format_filters_by_the_id(spark, sf_dir, asked):
    extract = dataclasses.replace(trade.extracts(spark, sf_dir)[0], id_format=None)
    one = extract.records().first().transaction_id
    assert extract.for_ids([*asked, one]).records().count() == 1


def test_traced_records_name_their_file(spark, sf_dir):
    extracts = trade.extracts_with_files(spark, sf_dir)
    actuals = ledger.build_ledger(extracts, trade.mapping(spark), closed_only=entry.SCENARIO)
    lines = entry.book_of(spark, sf_dir).lines
    traced = lineage.trace(extracts, trade.mapping(spark), actuals, lines, with_file=True)
    assert {r[0] for r in traced.select("source_file").distinct().collect()} == {"orders.parquet", "lineitem.parquet"}
