"""Unreadable values: set apart, counted, and harmless to the rest."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidebook.operators import checks
from tidebook.plans import staged_run
from tidebook.sources import cashbook, quarantine, schemas
from tidebook.sources.files import read_csv


def rejects(frame):
    return sorted(tuple(r) for r in frame.select(*quarantine.REJECT_COLUMNS).collect())


SALE = "raw/bitcoin_sales.csv"


def damaged(tmp_path):
    rows = sample.tables()
    rows[SALE][1][5] = "1,000"
    rows[SALE][2][1] = "2026-02-30"
    rows[SALE][2][3] = "four"
    rows[SALE][3][1] = "2026"
    rows["raw/loan_draws.csv"][0][4] = "12345678901234567890"
    return sample.write(tmp_path, rows)


def test_values_are_named_with_record_column_and_reason(spark, tmp_path):
    files = cashbook.CashbookFiles(spark, damaged(tmp_path), quarantine=True)
    ids = [r[0] for r in sample.tables()[SALE]]
    draw = sample.tables()["raw/loan_draws.csv"][0][0]
    assert rejects(files.rejects()) == sorted(
        [
            ("bitcoin_sales.csv", ids[1], "usd_received", "1,000", "not decimal(18,2)"),
            ("bitcoin_sales.csv", ids[2], "settlement_date", "2026-02-30", "not date"),
            ("bitcoin_sales.csv", ids[2], "btc_sold", "four", "not decimal(18,8)"),
            ("bitcoin_sales.csv", ids[3], "settlement_date", "2026", "not date"),
            ("loan_draws.csv", draw, "draw_amount", "12345678901234567890", "not decimal(18,2)"),
        ]
    )
    counted = {(r.feed, r.column_name): (r.n_values, r.n_records) for r in quarantine.reject_counts(files.rejects()).collect()}
    assert counted["bitcoin_sales.csv", "settlement_date"] == (2, 2)


def test_valid_rows_are_those_of_a_strict_read(spark, tmp_path):
    folder = damaged(tmp_path / "bad")
    bad = {r.record_id for r in cashbook.CashbookFiles(spark, folder, quarantine=True).rejects().collect()}
    valid = cashbook.CashbookFiles(spark, folder, quarantine=True)._split(*cashbook.FEEDS[0]).valid.drop("file_name")
    whole = read_csv(spark, f"{sample.write(tmp_path / 'good')}/{SALE}", schemas.SALES)
    assert valid.schema == whole.schema
    assert sorted(valid.collect()) == sorted(whole.filter(~F.col("sale_id").isin(*bad)).collect())
    assert valid.count() == 9 - 3


def test_sound_files_give_the_same_ledger_either_way(spark, tmp_path):
    folder = sample.write(tmp_path)
    plain, careful = (cashbook.CashbookFiles(spark, folder, quarantine=q) for q in (False, True))
    for one, other in zip(plain.extracts(), careful.extracts()):
        assert sorted(one.records().collect()) == sorted(other.records().collect())
    assert careful.rejects().collect() == [] and plain.rejects() is None


def test_lines_with_missing_or_extra_fields(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('draw_id,funding_date,facility_id\nA,2026-01-01,F\nB,2026-01-02\nC,2026-01-03,F,9\nD,,\n"E, x", 2026-01-04 ,F\n')
    schema = "draw_id string, funding_date date, facility_id string"
    split = quarantine.split_readable(quarantine.read_text_csv(spark, str(path), schema), schema, "draws", "draw_id")
    assert [r[1:] for r in rejects(split.rejects)] == [
        ("B", "_line", "B,2026-01-02", "wrong number of fields"),
        ("C", "_line", "C,2026-01-03,F,9", "wrong number of fields"),
    ]
    assert split.rejects.count() == 2  # counted without reading any declared column
    assert [(r.draw_id, str(r.funding_date)) for r in split.valid.orderBy("draw_id").collect()] == [
        ("A", "2026-01-01"), ("D", "None"), ("E, x", "2026-01-04"),
    ]


def test_empty_feed_and_other_columns(spark):
    raw = spark.createDataFrame([], "k string, v string, file_name string, _problems int")
    split = quarantine.split_readable(raw.drop("_problems"), "k string, v int", "feed", "k")
    assert split.valid.columns == ["k", "v", "file_name"] and split.valid.collect() == split.rejects.collect() == []


@pytest.mark.parametrize(("allowed", "fails"), [(0, True), (3, True), (4, False)])
def test_gate_counts_records(spark, tmp_path, allowed, fails):
    found = cashbook.CashbookFiles(spark, damaged(tmp_path), quarantine=True).rejects()
    (row,) = checks.reject_checks(found, allowed).collect()
    assert (row.observed, row.expected, row.passed) == ("4", str(allowed), not fails)


def test_a_run_publishes_past_allowed_rejects_and_keeps_them(spark, tmp_path):
    rows = sample.tables()
    rows["raw/capital_payments.csv"].append(["CAP-X", "soon", "P", "V", "Mining equipment", "5", "PAID"])
    folder, out = sample.write(tmp_path / "in", rows), str(tmp_path / "out")
    files = cashbook.CashbookFiles(spark, folder, quarantine=True)
    inputs = sample.inputs(spark, folder)

    def careful(allowed):
        return staged_run.Inputs(
            **{**vars(inputs), "extracts": files.extracts(), "rejects": files.rejects(), "allowed_rejects": allowed,
               "amount_tolerance_cents": 0, "id_buckets": 4}
        )

    with pytest.raises(checks.GateFailure) as failure:
        staged_run.run(spark, careful(0), out)
    assert failure.value.check_id == "unreadable_records" and staged_run.published_run(spark, out) is None
    tables = staged_run.run(spark, careful(1), out)
    assert staged_run.published_run(spark, out).endswith(tables.run_id)
    kept = spark.read.parquet(*glob.glob(f"{out}/runs/{tables.run_id}/unreadable_values"))
    assert rejects(kept) == [("capital_payments.csv", "CAP-X", "payment_date", "soon", "not date")]
    (found,) = tables.by_id.rows(spark, ["INV-PWR-2026-02", "none"]).collect()
    assert found.signed_amount_usd == -270000
