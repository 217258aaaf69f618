"""One mutation per gate; it must fail that gate and no earlier one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import tidebook.__main__ as cli
from tests import sample
from tidebook.operators import checks, forecast, ledger, reconcile, report
from tidebook.plans import staged_run
from tidebook.plans.scenario import ScenarioError
from tidebook.sources import cashbook


def folder_with(tmp_path, file, change):
    rows = sample.tables()
    change(rows[file])
    return sample.write(tmp_path, rows)


def first_failure(found):
    with pytest.raises(checks.GateFailure) as caught:
        checks.enforce(found)
    return caught.value.check_id


def close_checks(spark, folder):
    given = sample.inputs(spark, folder)
    rows = ledger.build_ledger(given.extracts, given.mapping)
    opening = ledger.opening_balance(given.bank)
    roster = rows.select("entity_id").distinct()
    return checks.combine(
        checks.mapping_checks(ledger.mapping_rules(given.mapping)),
        checks.ledger_checks(rows, given.scenario, given.vendor_sources),
        checks.opening_checks(opening, roster),
        checks.control_checks(checks.control_totals(rows), given.expectations.control_totals),
    )


PAYMENTS, SALES = "raw/operating_payments.csv", "raw/bitcoin_sales.csv"
AGREED = "reporting/agreed_figures.csv"


@pytest.mark.parametrize(
    ("file", "change", "gate"),
    [
        (PAYMENTS, lambda rows: rows[0].__setitem__(3, "Cooling"), "unmapped_category"),
        (PAYMENTS, lambda rows: rows.append(list(rows[0])), "repeated_transaction_id"),
        (PAYMENTS, lambda rows: rows[0].__setitem__(0, ""), "repeated_transaction_id"),
        (PAYMENTS, lambda rows: rows[0].__setitem__(2, "  "), "missing_counterparty"),
        ("raw/loan_draws.csv", lambda rows: rows[0].__setitem__(3, ""), "missing_counterparty"),
        (SALES, lambda rows: rows[0].__setitem__(1, "2026-10-01"), "outside_closed_window"),
        (SALES, lambda rows: rows[0].__setitem__(1, "2025-09-30"), "outside_closed_window"),
        (SALES, lambda rows: rows[0].__setitem__(1, ""), "outside_closed_window"),
        ("raw/bank_balance.csv", lambda rows: rows.append(list(rows[0])), "one_opening_record"),
        ("raw/bank_balance.csv", lambda rows: rows.clear(), "one_opening_record"),
        (PAYMENTS, lambda rows: rows[0].__setitem__(6, "260000.01"), "control_operating_outflow"),
        ("raw/loan_draws.csv", lambda rows: rows.clear(), "control_financing_inflow"),
        (
            "transformed/activity_mapping.csv",
            lambda rows: rows.append(list(rows[1])),
            "repeated_mapping_key",
        ),
    ],
)
def test_close(spark, tmp_path, file, change, gate):
    assert first_failure(close_checks(spark, folder_with(tmp_path, file, change))) == gate


def test_control_gates_have_their_own_order(spark, tmp_path):
    """Two totals move together: the one agreed on first is raised."""
    folder = folder_with(tmp_path, PAYMENTS, lambda rows: rows[0].__setitem__(6, "260000.01"))
    rows = close_checks(spark, folder).filter("NOT passed").orderBy("ord").collect()
    assert [r["check_id"] for r in rows] == ["control_operating_outflow", "control_all_net"]
    assert len({r["ord"] for r in rows}) == 2


def test_a_total_that_nobody_agreed_on_fails(spark, tmp_path):
    def shorter(rows):
        del rows[3]

    assert first_failure(close_checks(spark, folder_with(tmp_path, AGREED, shorter))) == "control_financing_inflow"


def test_an_empty_agreement_fails(spark, tmp_path):
    folder = folder_with(tmp_path, AGREED, lambda rows: rows.clear())
    given = sample.inputs(spark, folder)
    assert first_failure(close_checks(spark, folder)) == "control_agreement"
    none = given.expectations.opening
    opening = ledger.opening_balance(given.bank)
    assert first_failure(checks.opening_amount_checks(opening.limit(0), none)) == "opening_amount"
    assert first_failure(checks.opening_amount_checks(opening, none)) == "opening_amount"


@pytest.mark.parametrize(("row", "gate"), [(0, "control_operating_inflow"), (5, "opening_amount"), (6, "total_net_change"), (7, "final_balance")])
def test_a_run_with_a_wrong_agreed_figure_publishes_nothing(spark, tmp_path, row, gate):
    folder = folder_with(tmp_path / "in", AGREED, lambda rows: rows[row].__setitem__(3, 17))
    with pytest.raises(checks.GateFailure) as caught:
        cli.main(folder, str(tmp_path / "out"))
    assert caught.value.check_id == gate
    assert staged_run.published_run(spark, str(tmp_path / "out")) is None


def test_a_run_without_agreed_figures_says_so(spark, tmp_path):
    rows = sample.tables()
    del rows[AGREED]
    given = sample.inputs(spark, sample.write(tmp_path / "in", rows))
    tables = staged_run.run(spark, given, str(tmp_path / "out"))
    found = spark.read.parquet(f"{tmp_path}/out/runs/{tables.run_id}/checks").filter("stage = 'close'").collect()
    notice = {r["check_id"]: r for r in found}["figures_without_agreement"]
    assert (notice["violations"], notice["passed"]) == (4, True)


def test_other_statuses_are_dropped_silently(spark, tmp_path):
    def pending(rows):
        rows.append(["INV-X", "2026-05-05", "Someone", "Overhead", "", "", 5, "PENDING"])
        rows.append(["INV-Y", "2026-05-05", "Someone", "Overhead", "", "", 5, ""])

    folder = folder_with(tmp_path, PAYMENTS, pending)
    checks.enforce(close_checks(spark, folder))
    counts = ledger.status_counts(cashbook.CashbookFiles(spark, folder).extracts())
    dropped = {r["status"]: r["n_records"] for r in counts.filter("NOT kept").collect()}
    assert dropped == {"PENDING": 1, None: 1}


def test_status_text_is_normalised(spark, tmp_path):
    folder = folder_with(tmp_path, PAYMENTS, lambda rows: rows[0].__setitem__(7, " paid "))
    checks.enforce(close_checks(spark, folder))


def test_categories_from_costs_keep_their_case(spark, tmp_path):
    folder = folder_with(tmp_path, PAYMENTS, lambda rows: rows[1].__setitem__(3, "overhead"))
    assert first_failure(close_checks(spark, folder)) == "unmapped_category"


@pytest.mark.parametrize("change", [lambda r: r.append(list(r[0])), lambda r: r.clear()])
def test_scenario_table(spark, tmp_path, change):
    folder = folder_with(tmp_path, "reporting/forecast_scenario.csv", change)
    with pytest.raises(ScenarioError):
        cashbook.CashbookFiles(spark, folder).scenario()


def test_strict_close_raises(spark, tmp_path):
    folder = folder_with(tmp_path, SALES, lambda rows: rows[0].__setitem__(1, "2026-12-01"))
    given = sample.inputs(spark, folder)
    rows = ledger.build_ledger(given.extracts, given.mapping)
    with pytest.raises(ledger.ClosedWindowError):
        ledger.close_actuals(rows, given.scenario, strict=True)
    kept, rejects = ledger.close_actuals(rows, given.scenario)
    assert (kept.count(), rejects.count()) == (39, 1)


@pytest.fixture(scope="module")
def report_frames(spark, tmp_path_factory):
    given = sample.inputs(spark, sample.write(tmp_path_factory.mktemp("sample")))
    folder = str(tmp_path_factory.mktemp("tiers"))
    return given, staged_run.stage(given, f"{folder}/run")


def test_all_gates_of_a_good_run_pass(report_frames):
    checks.enforce(staged_run.run_checks(*report_frames))


def test_two_overrides_for_one_cell(spark, report_frames):
    given, tables = report_frames
    twice = spark.createDataFrame(
        [(cashbook.ENTITY, given.scenario.last_month, "Overhead paid", 5)] * 2,
        "entity_id string, reporting_month date, reporting_line string, amount_usd bigint",
    )
    profile = forecast.entity_profile(tables.totals, given.scenario, given.lines, tables.opening)
    rows = forecast.project_forecast(profile, given.scenario, given.lines, twice)
    found = checks.forecast_checks(rows, tables.opening, given.scenario, given.lines)
    assert first_failure(found) == "forecast_row_count"


def test_forecast_entity_left_out(spark, report_frames):
    given, tables = report_frames
    roster = spark.createDataFrame([(cashbook.ENTITY,), ("other",)], "entity_id string")
    found = checks.forecast_checks(tables.forecast, roster, given.scenario, given.lines)
    assert first_failure(found) == "forecast_row_count"


def test_unknown_line(report_frames):
    given, tables = report_frames
    cash = staged_run.ledger_totals(tables)
    odd = cash.withColumn(
        "reporting_line",
        F.when(F.col("reporting_line") != "Overhead paid", F.col("reporting_line")).otherwise("Other"),
    )
    null = cash.withColumn("reporting_line", F.lit(None).cast("string"))
    for totals in (odd, null):
        assert first_failure(checks.cash_checks(totals, given.scenario, given.lines)) == "unknown_reporting_line"
        assert checks.unknown_lines(totals, given.lines).count() > 0


def altered(frame, column):
    first = F.col("reporting_month") == F.lit("2026-03-01").cast("date")
    return frame.withColumn(column, F.col(column) + F.when(first, 1).otherwise(0))


@pytest.mark.parametrize("level", ["lines", "activities", "sections"])
def test_altered_report(report_frames, level):
    given, tables = report_frames
    cash = staged_run.ledger_totals(tables)
    if level == "sections":
        compared = reconcile.reconcile_sections(altered(tables.summary, "net_change_in_cash"), cash)
    else:
        reconciled = getattr(reconcile, f"reconcile_{level}")
        compared = reconciled(altered(tables.lines, "signed_amount_usd"), cash)
    wrong = compared.filter("NOT agrees").select("reporting_month").distinct().collect()
    assert [str(r[0]) for r in wrong] == ["2026-03-01"]


def test_ledger_group_without_report_row(report_frames):
    given, tables = report_frames
    partial = tables.lines.filter(F.col("reporting_line") != "Overhead paid")
    compared = reconcile.reconcile_lines(partial, staged_run.ledger_totals(tables))
    lost = compared.filter("NOT agrees").select("reporting_line").distinct().collect()
    assert [r[0] for r in lost] == ["Overhead paid"]


def test_broken_balance(report_frames):
    _, tables = report_frames
    scenario = report_frames[0].scenario
    adds = checks.summary_checks(altered(tables.summary, "net_change_in_cash"), scenario)
    assert first_failure(adds) == "balance_adds_up"
    shifted = altered(altered(tables.summary, "beginning_cash"), "ending_cash")
    assert first_failure(checks.summary_checks(shifted, scenario)) == "balance_continues"


@pytest.mark.parametrize(
    ("where", "gate"),
    [
        ("reporting_month <> DATE '2027-09-01'", "summary_row_count"),
        ("false", "summary_row_count"),
    ],
)
def test_missing_months(report_frames, where, gate):
    given, tables = report_frames
    found = checks.summary_checks(tables.summary.filter(where), given.scenario)
    assert first_failure(found) == gate
    short = checks.line_checks(tables.lines.filter(where), given.scenario, given.lines)
    assert first_failure(short) == "line_row_count"


def test_horizon_must_end_on_time(report_frames):
    given, tables = report_frames
    assert first_failure(checks.cash_checks(tables.totals, given.scenario, given.lines)) == "horizon_end"


def test_agreed_amounts(report_frames):
    given, tables = report_frames
    wrong = given.expectations.opening.withColumn("expected_amount", F.lit(1).cast("bigint"))
    found = [
        checks.opening_amount_checks(tables.opening, wrong),
        checks.net_change_checks(tables.summary, wrong),
        checks.final_balance_checks(tables.summary, wrong),
    ]
    assert [first_failure(f) for f in found] == ["opening_amount", "total_net_change", "final_balance"]


def test_an_agreed_amount_with_nothing_behind_it_fails(report_frames):
    given, tables = report_frames
    nobody = given.expectations.opening.withColumn("entity_id", F.lit("nobody"))
    assert first_failure(checks.opening_amount_checks(tables.opening, nobody)) == "opening_amount"


def test_failed_run_publishes_nothing(spark, tmp_path):
    bad = folder_with(tmp_path / "bad", PAYMENTS, lambda rows: rows.append(list(rows[0])))
    out = str(tmp_path / "out")
    with pytest.raises(checks.GateFailure) as caught:
        staged_run.run(spark, sample.inputs(spark, bad), out)
    assert caught.value.check_id == "repeated_transaction_id"
    assert staged_run.published_run(spark, out) is None


def test_mapping_fan_out_is_caught(report_frames):
    """A second rule would double its transactions; the id gate sees that as well."""
    given, _ = report_frames
    doubled = given.mapping.unionByName(given.mapping.filter("category = 'Overhead'"))
    rows = ledger.build_ledger(given.extracts, doubled)
    found = checks.ledger_checks(rows, given.scenario, given.vendor_sources)
    assert first_failure(found) == "repeated_transaction_id"


def test_report_from_cells_equals_report_from_profile(report_frames):
    """The two ways to fill gaps: zero cells added to ledgers, and calendar cells."""
    given, tables = report_frames
    profile = forecast.entity_profile(tables.totals, given.scenario, given.lines, tables.opening)
    cells = forecast.calendar_cells(profile, given.scenario, given.lines, given.plan)
    lines = report.monthly_lines(cells, given.scenario, given.lines).select(*tables.lines.columns)
    assert lines.count() == 126
    assert lines.exceptAll(tables.lines).count() == 0


def _cells(given, tables, **changed):
    profile = forecast.entity_profile(tables.totals, given.scenario, given.lines, tables.opening)
    frames = dict(
        report_lines=tables.lines,
        summary=tables.summary,
        cash=staged_run.ledger_totals(tables),
        forecast=tables.forecast,
        drivers=forecast.calendar_cells(profile, given.scenario, given.lines, given.plan, "forecast"),
    )
    return checks.cell_checks(**(frames | changed), scenario=given.scenario)


@pytest.mark.parametrize(
    ("frame", "column", "month", "failed"),
    [
        ("lines", "signed_amount_usd", "2026-03-01", ["line_equals_transactions", "activity_equals_transactions"]),
        (
            "lines", "signed_amount_usd", "2026-12-01",
            ["line_equals_transactions", "activity_equals_transactions", "report_matches_drivers"],
        ),
        ("summary", "net_operating_cash_flow", "2026-03-01", ["section_equals_transactions"]),
        ("summary", "net_change_in_cash", "2027-09-01", ["section_equals_transactions"]),
        ("forecast", "signed_amount_usd", "2026-12-01", ["forecast_matches_drivers"]),
    ],
)
def test_altered_cells_fail_the_gates_of_their_level(report_frames, frame, column, month, failed):
    given, tables = report_frames
    here = F.col("reporting_month") == F.lit(month).cast("date")
    rows = getattr(tables, frame).withColumn(column, F.col(column) + F.when(here, 1).otherwise(0))
    found = _cells(given, tables, **{{"lines": "report_lines"}.get(frame, frame): rows}).orderBy("ord").collect()
    assert len(found) == 5
    assert sorted(r.check_id for r in found if not r.passed) == sorted(failed)
    for r in found:
        assert r.passed == (r.violations == 0) and (r.sample_key is None) == r.passed
        if not r.passed:
            assert month in r.sample_key and int(r.observed) >= r.violations > 0


def test_rows_that_one_side_lacks_fail_at_their_levels(report_frames):
    given, tables = report_frames
    partial = tables.lines.filter("reporting_line <> 'Overhead paid'")
    lost = {r.check_id: r.violations for r in _cells(given, tables, report_lines=partial).filter("NOT passed").collect()}
    assert lost == {
        "line_equals_transactions": 21, "activity_equals_transactions": 21, "report_matches_drivers": 12,
    }
    extra = staged_run.ledger_totals(tables).limit(1).withColumn("reporting_line", F.lit(None).cast("string"))
    cash = staged_run.ledger_totals(tables).unionByName(extra)
    assert first_failure(_cells(given, tables, cash=cash)) == "line_equals_transactions"


def test_entity_rules_share_one_grouping(report_frames):
    given, tables = report_frames
    roster = tables.opening.select("entity_id")
    expected = given.expectations
    joint = checks.entity_checks(
        checks.opening_part(tables.opening, roster),
        checks.forecast_part(tables.forecast, roster, given.scenario, given.lines),
        checks.line_part(tables.lines, given.scenario, given.lines),
        checks.summary_part(tables.summary, given.scenario),
        checks.opening_amount_part(tables.opening, expected.opening),
        checks.net_change_part(tables.summary, expected.net_change),
        checks.final_balance_part(tables.summary, expected.final_balance),
    )
    apart = checks.combine(
        checks.opening_checks(tables.opening, roster),
        checks.forecast_checks(tables.forecast, roster, given.scenario, given.lines),
        checks.line_checks(tables.lines, given.scenario, given.lines),
        checks.summary_checks(tables.summary, given.scenario),
        checks.opening_amount_checks(tables.opening, expected.opening),
        checks.net_change_checks(tables.summary, expected.net_change),
        checks.final_balance_checks(tables.summary, expected.final_balance),
    )
    assert sorted(joint.collect()) == sorted(apart.collect()) and joint.count() == 13
    assert joint.filter("NOT passed").count() == 0


def test_entities_of_one_subject_are_not_missed_by_the_others(spark, report_frames):
    """An agreement on an entity that nobody reports fails its own gate and no other."""
    given, tables = report_frames
    nobody = given.expectations.opening.withColumn("entity_id", F.lit("nobody")).unionByName(given.expectations.opening)
    found = checks.entity_checks(
        checks.opening_part(tables.opening, tables.opening.select("entity_id")),
        checks.line_part(tables.lines, given.scenario, given.lines),
        checks.summary_part(tables.summary, given.scenario),
        checks.opening_amount_part(tables.opening, nobody),
    )
    assert [r.check_id for r in found.filter("NOT passed").collect()] == ["opening_amount"]
