from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidebook.sources import cashbook, schemas
from tidebook.sources.constants import constant_frame
from tidebook.sources.files import read_csv, write_csv, write_table


def test_declared_types_of_the_extracts(spark, tmp_path):
    folder = sample.write(tmp_path)
    sales = read_csv(spark, f"{folder}/raw/bitcoin_sales.csv", schemas.SALES)
    assert dict(sales.dtypes)["settlement_date"] == "date"
    assert sales.count() == 9
    power = read_csv(spark, f"{folder}/raw/operating_payments.csv", schemas.OPERATING_PAYMENTS)
    assert power.filter("mwh IS NULL").count() == 9


def test_documented_amount_identities_hold(spark, tmp_path):
    folder = sample.write(tmp_path)
    sales = read_csv(spark, f"{folder}/raw/bitcoin_sales.csv", schemas.SALES)
    assert sales.filter("btc_sold * usd_per_btc <> usd_received").count() == 0


def test_header_only_file_keeps_its_types(spark, tmp_path):
    plan = cashbook.CashbookFiles(spark, sample.write(tmp_path)).plan()
    assert plan.count() == 0
    assert dict(plan.dtypes) == {
        "entity_id": "string", "reporting_month": "date",
        "reporting_line": "string", "amount_usd": "bigint",
    }


@pytest.mark.parametrize("column", [1, 5])
def test_bad_value_fails_the_read(spark, tmp_path, column):
    rows = sample.tables()
    rows["raw/bitcoin_sales.csv"][3][column] = "not a value"
    folder = sample.write(tmp_path, rows)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, f"{folder}/raw/bitcoin_sales.csv", schemas.SALES).collect()


def test_wrong_header_fails_the_read(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("reporting_line,reporting_month,amount_usd\nA,2026-01-01,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), schemas.PLAN_SCHEDULE).collect()


def test_constant_frame_has_known_size(spark):
    frame = constant_frame(spark, [(dt.date(2026, 1, 1), 5)], "d date, n bigint")
    assert frame.collect() == [(dt.date(2026, 1, 1), 5)]
    assert "LocalTableScan" in frame._jdf.queryExecution().executedPlan().toString()
    assert constant_frame(spark, [], "d date, n bigint").count() == 0


def test_written_table_round_trip(spark, tmp_path):
    frame = spark.range(1000).select(
        F.expr("DATE '2026-01-01' + CAST(id % 3 * 31 AS INT)").alias("day"), F.col("id").alias("n")
    )
    back = write_table(frame, str(tmp_path / "t"), "day")
    assert back.columns == ["day", "n"]
    assert back.dtypes == frame.dtypes
    assert back.exceptAll(frame).count() == 0 and back.count() == 1000


def test_csv_parts_follow_the_order(spark, tmp_path):
    frame = spark.range(500).select((499 - F.col("id")).alias("n"), F.lit("").alias("t"))
    write_csv(frame.repartition(7), str(tmp_path / "c"), "n")
    lines = []
    for part in sorted((tmp_path / "c").glob("part*.csv")):
        lines += part.read_text().splitlines()[1:]
    assert lines == [f'{n},""' for n in range(500)]
