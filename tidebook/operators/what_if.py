"""What-ifs: other quantities and prices for the recurring lines, all of them in one plan.

The formula is ours. A line's driver is what its closing months moved on average,
the product of a quantity and a price. A what-if multiplies either of them, or sets the
price, and is rounded once per cell, to whole dollars, halves to even. Closed months
and planned amounts stay. Every what-if is a projection of the same cells, so any
number of them costs one pass over the ledger.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import text_literal
from tidebook.operators.forecast import calendar_cells
from tidebook.operators.ledger import classify
from tidebook.plans.lines import RECURRING, LineBook
from tidebook.plans.scenario import TRAILING_MONTHS, Scenario
from tidebook.sources.extract import Extract, priced_records

FACTOR, PRICE, QUANTITY_SUM = "decimal(7,4)", "decimal(13,4)", "decimal(18,4)"
CELL = ("entity_id", "reporting_month", "reporting_line")


@dataclass(frozen=True)
class Change:
    """Factors on a line's quantity and price; ``unit_price`` sets the price instead."""

    quantity: Decimal = Decimal(1)
    price: Decimal = Decimal(1)
    unit_price: Decimal | None = None

    def __post_init__(self) -> None:
        for value, places in ((self.quantity, 3), (self.price, 3), (self.unit_price or Decimal(0), 9)):
            if value < 0 or value >= 10**places or value != round(value, 4):
                raise ValueError(f"{value} is not a figure of up to {places} digits and 4 decimal places")


@dataclass(frozen=True)
class WhatIf:
    name: str
    changes: Mapping[str, Change] = field(default_factory=dict)


def quantity_drivers(extracts: Sequence[Extract], mapping: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    """Quantity behind each recurring line in the closing months, per entity; NULL prices count too."""
    records = classify(priced_records(extracts, scenario), mapping)
    month = F.trunc("cash_date", "month")
    closing = records.filter(scenario.trailing(month) & F.col("reporting_line").isin(lines.names(RECURRING)))
    return closing.groupBy("entity_id", "reporting_line").agg(F.sum("quantity").cast(QUANTITY_SUM).alias("quantity"))


def _checked(what_ifs: Sequence[WhatIf], lines: LineBook) -> None:
    names = [w.name for w in what_ifs]
    if len(set(names)) != len(names) or not names:
        raise ValueError("what-ifs need different names, and at least one is needed")
    for w in what_ifs:
        unknown = set(w.changes) - set(lines.names(RECURRING))
        if unknown:
            raise ValueError(f"{w.name} changes lines that have no run rate: {sorted(unknown)}")


def _driver(what_ifs: Sequence[WhatIf], lines: LineBook) -> str:
    """SQL for the changed driver of a cell."""
    sign = {x.reporting_line: 1 if x.cash_direction == "inflow" else -1 for x in lines}
    cases = []
    for w in what_ifs:
        for line, c in w.changes.items():
            if c.unit_price is None:
                changed = f"driver_amount_usd * CAST({c.quantity} AS {FACTOR}) * CAST({c.price} AS {FACTOR})"
            else:
                priced = f"quantity * CAST({c.quantity} AS {FACTOR}) * CAST({c.unit_price} AS {PRICE})"
                changed = f"{sign[line]} * {priced} / {TRAILING_MONTHS}"
            here = f"what_if = {text_literal(w.name)} AND reporting_line = {text_literal(line)}"
            cases.append(f"WHEN {here} THEN CAST(bround({changed}, 0) AS BIGINT)")
    return f"CASE {' '.join(cases)} ELSE driver_amount_usd END" if cases else "driver_amount_usd"


def what_if_lines(
    profile: DataFrame,
    scenario: Scenario,
    lines: LineBook,
    what_ifs: Sequence[WhatIf],
    plan: DataFrame | None = None,
    quantities: DataFrame | None = None,
) -> DataFrame:
    """Amount per what-if, entity, month and line.

    ``quantities`` (``quantity_drivers``) are needed where a what-if sets a price; an
    entity without any keeps a NULL driver there, which counts as zero.
    """
    _checked(what_ifs, lines)
    cells = calendar_cells(profile, scenario, lines, plan)
    if any(c.unit_price is not None for w in what_ifs for c in w.changes.values()):
        if quantities is None:
            raise ValueError("a what-if that sets a price needs quantities")
        cells = cells.join(quantities, ["entity_id", "reporting_line"], "left")
    names = F.array(*[F.lit(w.name) for w in what_ifs])
    each = cells.select("*", F.explode(names).alias("what_if"))
    projected = F.coalesce("plan_amount_usd", F.expr(_driver(what_ifs, lines)), F.lit(0))
    amount = F.when(scenario.is_open(F.col("reporting_month")), projected).otherwise(
        F.coalesce("closed_amount_usd", F.lit(0))
    )
    return each.select(
        "what_if",
        *CELL,
        "cash_flow_section",
        scenario.amount_type(F.col("reporting_month")).alias("amount_type"),
        amount.cast("bigint").alias("signed_amount_usd"),
    )


def what_if_balances(changed_lines: DataFrame, opening: DataFrame) -> DataFrame:
    """Net change and ending cash of every what-if, entity and month."""
    key = ["what_if", "entity_id"]
    net = changed_lines.groupBy(*key, "reporting_month", "amount_type").agg(
        F.sum("signed_amount_usd").alias("net_change_in_cash")
    )
    so_far = F.sum("net_change_in_cash").over(Window.partitionBy(*key).orderBy("reporting_month"))
    start = opening.select("entity_id", "available_balance_usd")
    return net.withColumn("_so_far", so_far).join(start, "entity_id", "left").select(
        *key, "reporting_month", "amount_type", "net_change_in_cash",
        (F.col("available_balance_usd") + F.col("_so_far")).alias("ending_cash"),
    )
