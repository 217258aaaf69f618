"""What-ifs, growth and backtest against plain Python."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidebook.operators import backtest, forecast, what_if
from tidebook.operators.what_if import Change, WhatIf
from tidebook.plans.growth import Growth
from tidebook.plans.lines import RECURRING
from tidebook.plans.scenario import Scenario, shift_month

SCENARIO, LINES = entry.SCENARIO, entry.LINES


@pytest.fixture(scope="module")
def book(spark):
    return entry.book_of(spark, "/root/testdata/sf0.001", planned=True)


def keyed(frame, *keys, value="signed_amount_usd"):
    return {tuple(r[k] for k in keys): r[value] for r in frame.collect()}


CELL = ("entity_id", "reporting_month", "reporting_line")


def test_neutral_what_if_is_the_report(book):
    found = what_if.what_if_lines(book.profile, SCENARIO, LINES, [WhatIf("as is")], book.plan)
    assert keyed(found, *CELL) == keyed(book.lines, *CELL)


def test_what_ifs_by_hand(book):
    line = "Overhead paid"
    what_ifs = [WhatIf("as is"), WhatIf("half", {line: Change(Decimal("0.5"), Decimal("1.5"))}), WhatIf("free", {line: Change(price=Decimal(0))})]
    found = keyed(what_if.what_if_lines(book.profile, SCENARIO, LINES, what_ifs, book.plan), "what_if", *CELL)
    drivers = keyed(forecast.line_drivers(book.profile, LINES), "entity_id", "reporting_line", value="driver_amount_usd")
    planned = keyed(book.plan, *CELL, value="amount_usd")
    factor = {"as is": Decimal(1), "half": Decimal("0.75"), "free": Decimal(0)}
    assert len(found) == 3 * len(keyed(book.lines, *CELL))
    for (name, entity, month, reporting_line), amount in found.items():
        if month <= SCENARIO.last_closed_month or reporting_line != line:
            assert amount == found["as is", entity, month, reporting_line]
        elif (entity, month, line) in planned:
            assert amount == planned[entity, month, line]
        else:
            driver = Decimal(drivers[entity, line] or 0)
            assert amount == int((driver * factor[name]).quantize(Decimal(1), ROUND_HALF_EVEN))


def test_balances_of_what_ifs_continue(book):
    lines = what_if.what_if_lines(book.profile, SCENARIO, LINES, [WhatIf("as is"), WhatIf("x", {"Parts paid": Change(Decimal(2))})], book.plan)
    found = keyed(what_if.what_if_balances(lines, book.opening), "what_if", "entity_id", "reporting_month", value="ending_cash")
    today = keyed(book.summary, "entity_id", "reporting_month", value="ending_cash")
    assert {k[1:]: v for k, v in found.items() if k[0] == "as is"} == today
    assert any(found["x", *k] != v for k, v in today.items())


def test_what_ifs_cost_one_pass_over_the_facts(book):
    def scans(n):
        many = [WhatIf(str(i), {"Parts paid": Change(Decimal(i))}) for i in range(n)]
        frame = what_if.what_if_lines(book.profile, SCENARIO, LINES, many, book.plan)
        return frame._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")

    assert scans(40) == scans(1) > 0


@pytest.mark.parametrize(
    "what_ifs",
    [[], [WhatIf("a"), WhatIf("a")], [WhatIf("a", {"Credit drawn": Change()})], [WhatIf("a", {"Nothing": Change()})]],
)
def test_what_ifs_that_make_no_sense(book, what_ifs):
    with pytest.raises(ValueError):
        what_if.what_if_lines(book.profile, SCENARIO, LINES, what_ifs)


@pytest.mark.parametrize("value", ["-1", "1.23456", "1000"])
def test_changes_out_of_range(value):
    with pytest.raises(ValueError):
        Change(quantity=Decimal(value))


def test_a_price_needs_quantities(book):
    with pytest.raises(ValueError, match="quantities"):
        what_if.what_if_lines(book.profile, SCENARIO, LINES, [WhatIf("p", {"Parts paid": Change(unit_price=Decimal(5))})])


def test_no_growth_is_the_forecast(book):
    plain = sorted(map(tuple, book.forecast.collect()))
    for growth in (Growth({}), Growth({"Overhead paid": Decimal(0)})):
        assert sorted(map(tuple, forecast.project_forecast(book.profile, SCENARIO, LINES, book.plan, growth).collect())) == plain


def test_growth_by_hand(book):
    growth = Growth({"Order cash received": Decimal("0.0123"), "Buildout paid": Decimal("0.5"), "Parts paid": Decimal("-0.02")})
    grown = keyed(forecast.project_forecast(book.profile, SCENARIO, LINES, book.plan, growth), *CELL)
    plain = keyed(book.forecast, *CELL)
    drivers = keyed(forecast.line_drivers(book.profile, LINES), "entity_id", "reporting_line", value="driver_amount_usd")
    recurring = set(LINES.names(RECURRING))
    for (entity, month, line), amount in grown.items():
        rate = growth.rates.get(line)
        if rate is None or line not in recurring:  # other lines do not grow
            assert amount == plain[entity, month, line]
            continue
        factor = Decimal(1)
        while month > SCENARIO.last_closed_month:
            factor = (factor * (1 + rate)).quantize(Decimal("1e-12"), ROUND_HALF_UP)
            month = shift_month(month, -1)
        assert amount == int((Decimal(drivers[entity, line] or 0) * factor).quantize(Decimal(1), ROUND_HALF_EVEN))


@pytest.mark.parametrize("rate", ["-1", "3"])
def test_growth_out_of_range(rate):
    with pytest.raises(ValueError):
        Growth({"x": Decimal(rate)}).factors("x", 12)


def test_backtest_by_hand(book):
    totals = keyed(book.totals.groupBy(*CELL).agg(F.sum("signed_amount_usd").alias("t")), *CELL, value="t")
    rows = backtest.backtest(book.profile, SCENARIO, LINES).collect()
    months = [dt.date(2000, m, 1) for m in range(1, 10)]
    assert len(rows) == len({r.entity_id for r in rows}) * 4 * (6 + 5 + 4 + 3 + 2 + 1)
    for r in rows:
        past = [totals.get((r.entity_id, m, r.reporting_line)) for m in months if m <= r.close_month]
        if r.reporting_line == "Buildout paid":
            projected = next((t for t in reversed(past) if t is not None), 0)
        else:
            third = Decimal(sum(t or 0 for t in past[-3:])) / 3
            projected = int(third.quantize(Decimal(1), ROUND_HALF_UP))
        assert r.forecast_usd == projected
        assert r.actual_usd == totals.get((r.entity_id, r.reporting_month, r.reporting_line), 0)
        assert r.error_usd == r.forecast_usd - r.actual_usd and shift_month(r.close_month, r.months_ahead) == r.reporting_month


def test_backtest_needs_months(book):
    with pytest.raises(ValueError):
        backtest.backtest(book.profile, Scenario("3+12", 2000, 3, 12), LINES)


def test_accuracy_without_movement_has_no_share(spark):
    cells = spark.createDataFrame([("x", 0, 0, 0), ("y", 5, -10, 15)], "k string, forecast_usd long, actual_usd long, error_usd long")
    found = {r.k: (r.absolute_error_usd, r.error_milli) for r in backtest.accuracy(cells, "k").collect()}
    assert found == {"x": (0, None), "y": (15, 1500)}
