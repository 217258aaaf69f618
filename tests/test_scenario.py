from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidebook.plans.lines import LineBook
from tidebook.plans.scenario import Scenario, ScenarioError, shift_month
from tidebook.sources.cashbook import LINES


def test_months_of_the_sample():
    scenario = Scenario("9+12", 2026, 9, 12)
    assert scenario.first_month == dt.date(2026, 1, 1)
    assert scenario.last_closed_month == dt.date(2026, 9, 1)
    assert scenario.first_open_month == dt.date(2026, 10, 1)
    assert scenario.first_trailing_month == dt.date(2026, 7, 1)
    assert scenario.last_month == dt.date(2027, 9, 1)
    assert scenario.total_months == 21


def test_short_year_reaches_back_instead_of_failing():
    assert Scenario("1+2", 2026, 1, 2).first_trailing_month == dt.date(2025, 11, 1)


@given(st.integers(1950, 2090), st.integers(1, 12), st.integers(-400, 400))
def test_shift_month_is_invertible(year, month, n):
    start = dt.date(year, month, 1)
    assert shift_month(shift_month(start, n), -n) == start


@pytest.mark.parametrize(
    "row", [("9+12", 2026, 9, 11), ("0+12", 2026, 0, 12), ("13+1", 2026, 13, 1), ("9+0", 2026, 9, 0)]
)
def test_unusable_scenarios(row):
    with pytest.raises(ScenarioError):
        Scenario(*row)


@pytest.mark.parametrize("rows", [[], [("9+12", 2026, 9, 12)] * 2, [("9+12", None, 9, 12)]])
def test_the_table_holds_one_full_row(spark, rows):
    table = spark.createDataFrame(
        rows, "scenario string, fiscal_year int, actual_months int, forecast_months int"
    )
    with pytest.raises(ScenarioError):
        Scenario.from_frame(table)


def test_line_book_rejects_repeats():
    with pytest.raises(ValueError):
        LineBook([*LINES, next(iter(LINES))])


def test_line_book_columns():
    assert [x.column for x in LINES][:2] == ["mining_cash_received", "mining_power_paid"]
