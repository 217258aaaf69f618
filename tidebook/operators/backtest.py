"""How well the forecast would have done: every earlier close, against what came later.

The measure is ours. For each close c of the closed window that has a full run of
trailing months, every line is projected as it would have been then, and set beside
the amounts of the closed months after c. All closes are projections of the
profile's closed amounts, so they need no pass over the ledger of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import text_literal
from tidebook.plans.lines import LAST_MONTH, RECURRING, Line, LineBook
from tidebook.plans.scenario import TRAILING_MONTHS, Scenario, shift_month


def _amount(line: Line, month: dt.date) -> str:
    name = text_literal(line.reporting_line)
    return f"element_at(closed_amounts, struct(DATE '{month}' AS reporting_month, {name} AS reporting_line))"


def _projection(line: Line, months: list[dt.date]) -> str:
    """What the line's driver was when the last of ``months`` had just closed."""
    if line.driver_kind == RECURRING:
        total = " + ".join(f"coalesce({_amount(line, m)}, 0)" for m in months[-TRAILING_MONTHS:])
        return f"CAST(round(({total}) / {TRAILING_MONTHS}) AS BIGINT)"
    if line.driver_kind == LAST_MONTH:
        latest = ", ".join(_amount(line, m) for m in reversed(months))
        return f"coalesce({latest}, 0)"
    return "CAST(0 AS BIGINT)"


def backtest(profile: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    """One row per entity, close, later closed month and line: forecast, actual and error.

    Lines without a driver are left out: what is planned is no forecast.
    """
    months = [shift_month(scenario.first_month, n) for n in range(scenario.actual_months)]
    rows = [
        f"struct(DATE '{months[c - 1]}' AS close_month, {text_literal(line.cash_flow_section)} AS cash_flow_section, "
        f"{text_literal(line.reporting_line)} AS reporting_line, "
        f"CAST({_projection(line, months[:c])} AS BIGINT) AS forecast_usd)"
        for c in range(TRAILING_MONTHS, len(months))
        for line in lines
        if line.driver_kind in (RECURRING, LAST_MONTH)
    ]
    if not rows:
        raise ValueError("a backtest needs a closed month after the trailing ones, and a line with a driver")
    projected = profile.select("entity_id", "closed_amounts", F.expr(f"inline(array({', '.join(rows)}))"))
    later = F.expr(f"sequence(add_months(close_month, 1), DATE '{months[-1]}', INTERVAL 1 MONTH)")
    found = projected.select("*", F.posexplode(later).alias("_place", "reporting_month"))
    actual = F.expr("coalesce(element_at(closed_amounts, struct(reporting_month, reporting_line)), 0)")
    return found.select(
        "entity_id",
        "close_month",
        "reporting_month",
        (F.col("_place") + 1).alias("months_ahead"),
        "cash_flow_section",
        "reporting_line",
        "forecast_usd",
        actual.alias("actual_usd"),
        (F.col("forecast_usd") - actual).alias("error_usd"),
    )


def accuracy(cells: DataFrame, *by: str) -> DataFrame:
    """Errors added up: bias, absolute error, and the share of it in the actual amounts, in thousandths.

    The share is cut to whole thousandths, and NULL where nothing moved.
    """
    size: Column = F.sum(F.abs("actual_usd"))
    off: Column = F.sum(F.abs("error_usd"))
    return cells.groupBy(*by).agg(
        F.count("*").alias("n_cells"),
        F.sum("forecast_usd").alias("forecast_usd"),
        F.sum("actual_usd").alias("actual_usd"),
        F.sum("error_usd").alias("bias_usd"),
        off.alias("absolute_error_usd"),
        F.when(size > 0, F.call_function("div", off * 1000, size)).alias("error_milli"),
    )
