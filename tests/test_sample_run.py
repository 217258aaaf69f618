"""The sample folder end to end."""

from __future__ import annotations

import csv
import glob

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidebook.operators import checks, forecast, lineage, report
from tidebook.plans import staged_run
from tidebook.sources import cashbook
from tidebook.sources.constants import constant_frame


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = sample.write(tmp_path_factory.mktemp("sample"))
    out = str(tmp_path_factory.mktemp("out"))
    inputs = sample.inputs(spark, folder)
    tables = staged_run.run(spark, inputs, out)
    staged_run.export_csv(tables, f"{out}/csv", single_entity=True, single_file=True)
    return inputs, tables, out


def read_back(out, name):
    (path,) = glob.glob(f"{out}/csv/{name}/part*.csv")
    with open(path) as file:
        return list(csv.DictReader(file))


def test_ledger(run):
    rows = read_back(run[2], "cash_transactions")
    assert len(rows) == 40
    assert list(rows[0]) == [
        "transaction_id", "source_system", "source_file", "source_category", "vendor",
        "cash_date", "reporting_month", "business_activity", "cash_flow_section",
        "reporting_line", "cash_direction", "signed_amount_usd",
    ]
    assert rows[0]["transaction_id"] == "DRAW-CL-2026-01"
    assert rows == sorted(rows, key=lambda r: (r["cash_date"], r["transaction_id"]))
    power = next(r for r in rows if r["transaction_id"] == "INV-PWR-2026-02")
    assert power["signed_amount_usd"] == "-270000"
    assert power["source_file"] == "operating_payments.csv"
    assert power["cash_flow_section"] == "Operating"


def test_forecast(run):
    rows = read_back(run[2], "forecast_transactions")
    assert len(rows) == 72
    assert {r["reporting_month"] for r in rows} == {
        f"{2026 + m // 12}-{m % 12 + 1:02d}-01" for m in range(9, 21)
    }
    for row in rows:
        assert int(row["signed_amount_usd"]) == sample.PROJECTED[row["reporting_line"]]
        assert row["source_file"] == "forecast_scenario.csv"
    assert rows[0]["transaction_id"] == "FCST-DC-2026-10"


def test_lines(run):
    actual = read_back(run[2], "actual_cash_flow_lines")
    projected = read_back(run[2], "forecast_cash_flow_lines")
    assert (len(actual), len(projected)) == (54, 72)
    january = [int(r["signed_amount_usd"]) for r in actual[:6]]
    assert january == [300000, -260000, -60000, -100000, 0, 500000]
    assert [r["display_order"] for r in actual[:6]] == list("123456")


def test_summary(run):
    rows = read_back(run[2], "actual_cash_summary") + read_back(run[2], "forecast_cash_summary")
    assert [int(r["ending_cash"]) for r in rows] == sample.ENDING_CASH
    assert list(rows[0]) == [
        "reporting_month", "amount_type", "mining_cash_received", "mining_power_paid",
        "overhead_paid", "net_operating_cash_flow", "data_center_buildout_paid",
        "mining_equipment_paid", "net_investing_cash_flow", "construction_loan_drawn",
        "net_financing_cash_flow", "net_change_in_cash", "beginning_cash", "ending_cash",
    ]
    assert int(rows[0]["beginning_cash"]) == sample.OPENING
    assert [int(r["beginning_cash"]) for r in rows[1:]] == sample.ENDING_CASH[:-1]
    assert sum(int(r["net_change_in_cash"]) for r in rows) == -7000012


def test_opening(run):
    (row,) = read_back(run[2], "opening_balance")
    assert row == {
        "account_id": "ACCT-USD-100100", "balance_date": "2026-12-31",
        "currency": "USD", "available_balance_usd": "2000000",
    }


def test_every_gate_has_a_row_and_passed(spark, run):
    rows = spark.read.parquet(f"{run[2]}/runs/{run[1].run_id}/checks").collect()
    assert len(rows) == len({r["check_id"] for r in rows}) == 34
    assert all(r["passed"] for r in rows)


def test_published(spark, run):
    assert staged_run.published_run(spark, run[2]) == f"{run[2]}/runs/{run[1].run_id}"


def test_trace_two_payments(spark, run):
    inputs, tables, _ = run
    wanted = ["PAY-MIN-EQ-2026-02", "INV-PWR-2026-02"]
    ids = constant_frame(spark, [(i,) for i in wanted], "transaction_id string")
    traced = lineage.trace(inputs.extracts, inputs.mapping, tables.actuals, tables.lines, ids)
    rows = {r["transaction_id"]: r for r in traced.collect()}
    assert set(rows) == set(wanted)
    for row in rows.values():
        assert row["outcome"] == "reported" and row["booked_once"] and row["rule_agrees"]
    assert rows["PAY-MIN-EQ-2026-02"]["line_amount_usd"] == -500000
    assert rows["INV-PWR-2026-02"]["rule_section"] == "Operating"
    sums = lineage.trace_line_sums(tables.actuals, tables.lines, ids).collect()
    assert len(sums) == 2 and all(r["agrees"] and r["n_transactions"] == 1 for r in sums)
    picked = tables.actuals.join(ids, "transaction_id", "left_semi")
    by_section = report.rollup_by(picked, "cash_flow_section").orderBy("section_order").collect()
    assert [(r[0], r[1]) for r in by_section] == [("Operating", -270000), ("Investing", -500000)]
    by_activity = report.rollup_by(picked, "business_activity").collect()
    assert [tuple(r) for r in by_activity] == [("Bitcoin mining operations", -770000)]


def test_unknown_id_is_reported_missing(spark, run):
    inputs, tables, _ = run
    ids = constant_frame(spark, [("NOPE",), ("INV-OH-2026-01",)], "transaction_id string")
    rows = lineage.id_presence(ids, inputs.extracts, tables.actuals).collect()
    assert {r["transaction_id"]: r["found_once"] for r in rows} == {
        "NOPE": False, "INV-OH-2026-01": True,
    }


def test_drilldown_of_one_cell(run):
    tables = run[1]
    month = run[0].scenario.last_closed_month
    rows = lineage.drilldown(tables.actuals, month, "Overhead paid").collect()
    assert [r["transaction_id"] for r in rows] == ["INV-OH-2026-09"]


def test_drilldown_reads_one_partition_of_the_staged_ledger(run):
    inputs, tables, _ = run
    rows = lineage.drilldown(tables.actuals, inputs.scenario.last_closed_month, "Overhead paid")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "window" in pruned and "reporting_month" in pruned


def test_period_spine(spark, run):
    scenario = run[0].scenario
    rows = forecast.period_spine(spark, scenario).orderBy("reporting_month").collect()
    assert [r["amount_type"] for r in rows] == ["Actual"] * 9 + ["Forecast"] * 12
    assert rows[0][0] == scenario.first_month and rows[-1][0] == scenario.last_month
    assert forecast.period_spine(spark, scenario, "actual").count() == 9


def test_override_replaces_the_driver(spark, run):
    inputs, tables, _ = run
    plan = constant_frame(
        spark,
        [
            (cashbook.ENTITY, sample_month(2026, 12), "Mining equipment paid", -250000),
            (cashbook.ENTITY, sample_month(2027, 1), "Overhead paid", -1),
            (cashbook.ENTITY, sample_month(2026, 3), "Overhead paid", -2),
        ],
        "entity_id string, reporting_month date, reporting_line string, amount_usd bigint",
    )
    profile = forecast.entity_profile(tables.totals, inputs.scenario, inputs.lines, tables.opening)
    rows = forecast.project_forecast(profile, inputs.scenario, inputs.lines, plan)
    planned = rows.filter(F.col("source_file") == "plan_schedule.csv").collect()
    assert {(r["transaction_id"], r["signed_amount_usd"]) for r in planned} == {
        ("FCST-EQ-2026-12", -250000), ("FCST-OH-2027-01", -1),
    }
    assert rows.count() == 72
    unused = forecast.unused_overrides(plan, tables.opening, inputs.scenario, inputs.lines)
    assert [r["amount_usd"] for r in unused.collect()] == [-2]
    (notice,) = checks.unused_override_checks(unused).collect()
    assert notice["violations"] == 1 and notice["passed"]


def sample_month(year, month):
    import datetime as dt

    return dt.date(year, month, 1)
