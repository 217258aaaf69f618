"""CSV exports: entities told apart, and rows in order over several part files."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidebook.plans import staged_run
from tidebook.sources.files import write_csv


def test_entities_and_order_over_part_files(spark, sf_dir, tmp_path):
    book = registry.Book(spark, sf_dir)
    two = F.col("entity_id").isin("3", "11")
    tables = staged_run.Tables(
        run_id="x",
        ledger=staged_run.with_window(book.full_ledger.filter(two), registry.SCENARIO),
        totals=book.totals.filter(two),
        opening=book.opening.filter(two),
        forecast=book.forecast.filter(two),
        lines=book.lines.filter(two),
        summary=book.summary.filter(two),
    )
    staged_run.export_csv(tables, str(tmp_path / "csv"), single_entity=False)
    lines = spark.read.option("header", True).csv(f"{tmp_path}/csv/forecast_cash_flow_lines")
    assert {r[0] for r in lines.select("entity_id").distinct().collect()} == {"3", "11"}
    assert lines.count() == 2 * 12 * 6


def test_order_follows_the_part_files(spark, tmp_path):
    folder = str(tmp_path / "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(spark.range(2000).select((F.col("id") * 7919 % 2000).alias("n"), F.lit("x").alias("t")), folder, "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(glob.glob(f"{folder}/part-*.csv"))
    read = [int(line.split(",")[0]) for p in parts for line in open(p).read().splitlines()[1:]]
    assert len(parts) > 1 and read == list(range(2000))
