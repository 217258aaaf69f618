"""Random closed totals against a plain Python model of the whole report."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidebook.operators import forecast, reconcile, report
from tidebook.plans.lines import LAST_MONTH, RECURRING
from tidebook.plans.scenario import Scenario, shift_month
from tidebook.sources import trade
from tidebook.sources.constants import constant_frame

LINES = trade.LINES
CASES = st.integers(1, 12).flatmap(
    lambda closed: st.tuples(
        st.builds(
            lambda ahead: Scenario(f"{closed}+{ahead}", 2024, closed, ahead), st.integers(1, 15)
        ),
        st.lists(
            st.tuples(
                st.sampled_from(["a", "b", "c"]),
                st.integers(0, closed - 1),
                st.sampled_from([*LINES.names(), "Unlisted line"]),
                st.integers(-10**9, 10**9),
            ),
            max_size=60,
        ),
        st.lists(
            st.tuples(
                st.sampled_from(["a", "d"]),
                st.integers(0, 30),
                st.sampled_from([*LINES.names(), "Unlisted line"]),
                st.integers(-1000, 1000),
            ),
            max_size=6,
            unique_by=lambda row: row[:3],
        ),
    )
)


def half_away(numerator: int, divisor: int) -> int:
    size = (2 * abs(numerator) + divisor) // (2 * divisor)
    return size if numerator >= 0 else -size


def model(scenario, totals, plan, opening):
    """Ending cash and lines per entity, worked out cell by cell."""
    cells = defaultdict(int)
    active = defaultdict(set)
    for entity, month, line, amount in totals:
        cells[entity, month, line] += amount
        active[entity, line].add(month)
    planned = {row[:3]: row[3] for row in plan}
    lines, endings = {}, {}
    for entity in {row[0] for row in totals} | set(opening):
        balance = opening.get(entity)
        for n in range(scenario.total_months):
            month = shift_month(scenario.first_month, n)
            for line in LINES:
                name = line.reporting_line
                if n < scenario.actual_months:
                    amount = cells.get((entity, month, name), 0)
                elif (entity, month, name) in planned:
                    amount = planned[entity, month, name]
                elif line.driver_kind == RECURRING:
                    trailing = [shift_month(scenario.last_closed_month, -k) for k in range(3)]
                    amount = half_away(sum(cells.get((entity, m, name), 0) for m in trailing), 3)
                elif line.driver_kind == LAST_MONTH and active[entity, name]:
                    amount = cells[entity, max(active[entity, name]), name]
                else:
                    amount = 0
                lines[entity, month, name] = amount
                balance = None if balance is None else balance + amount
            endings[entity, month] = balance
    return lines, endings


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(CASES)
def test_report_equals_the_model(spark, case):
    scenario, raw, raw_plan = case

    def dated(rows):
        return [(e, shift_month(scenario.first_month, n), line, x) for e, n, line, x in rows]

    totals_rows, plan_rows = dated(raw), dated(raw_plan)
    opening_rows = {"a": 100, "d": -7}
    cell = "entity_id string, reporting_month date, reporting_line string, "
    totals = constant_frame(spark, totals_rows, cell + "signed_amount_usd bigint")
    plan = constant_frame(spark, plan_rows, cell + "amount_usd bigint")
    opening = constant_frame(
        spark, list(opening_rows.items()), "entity_id string, available_balance_usd bigint"
    )
    profile = forecast.entity_profile(totals, scenario, LINES, opening)
    cells = forecast.calendar_cells(profile, scenario, LINES, plan)
    monthly = report.monthly_lines(cells, scenario, LINES)
    summary = report.monthly_summary(monthly, opening, LINES)

    lines, endings = model(scenario, totals_rows, plan_rows, opening_rows)
    got = monthly.collect()
    assert len(got) == len(lines)
    assert {(r[0], r["reporting_month"], r["reporting_line"]): r["signed_amount_usd"] for r in got} == lines
    assert {(r[0], r[1]): r["ending_cash"] for r in summary.collect()} == endings

    booked = report.cash_cells(
        totals, forecast.project_forecast(profile, scenario, LINES, plan)
    )
    wrong = reconcile.reconcile_lines(monthly, booked).filter("NOT agrees").collect()
    assert {r["reporting_line"] for r in wrong} <= {"Unlisted line"}
    unused = forecast.unused_overrides(plan, opening, scenario, LINES).collect()
    usable = [
        r for r in plan_rows
        if scenario.first_open_month <= r[1] <= scenario.last_month and r[2] in LINES.names()
    ]
    assert len(unused) == len(plan_rows) - len(usable)
