"""Monthly lines, monthly summary, roll-forward, rollups and measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import text_literal
from tidebook.plans.lines import SECTIONS, LineBook, section_rank
from tidebook.plans.scenario import Scenario

CELL = ("entity_id", "reporting_month", "reporting_line")


def zero_cells(entities: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    """A zero for every entity, month and line, without a cross join."""
    return (
        entities.select("entity_id", F.explode(scenario.months("all")).alias("reporting_month"))
        .withColumn("reporting_line", F.explode(F.array(*[F.lit(n) for n in lines.names()])))
        .withColumn("signed_amount_usd", F.lit(0).cast("bigint"))
    )


def cash_cells(*frames: DataFrame) -> DataFrame:
    """Union of ledgers, totals or zero cells, cut down to what a report line needs."""
    picked = [f.select(*CELL, "signed_amount_usd") for f in frames]
    cells = picked[0]
    for more in picked[1:]:
        cells = cells.unionByName(more)
    return cells


def monthly_lines(cells: DataFrame, scenario: Scenario, lines: LineBook) -> DataFrame:
    """Amount per entity, month and line.

    Gaps are filled by zero cells among the input: they join the sum instead of
    being the left side of an outer join, so there is one shuffle and no
    fan-out. Cells outside the horizon or of an unknown line take no part, as
    the reconciliation reports.
    """
    amounts = (
        cells.filter(scenario.in_horizon(F.col("reporting_month")))
        .groupBy(*CELL)
        .agg(F.sum("signed_amount_usd").alias("signed_amount_usd"))
    )
    attributes = lines.frame(cells.sparkSession).select(
        "reporting_line", "cash_flow_section", "business_activity", "display_order"
    )
    return amounts.join(attributes, "reporting_line").select(
        "entity_id",
        "reporting_month",
        "cash_flow_section",
        "business_activity",
        "reporting_line",
        "signed_amount_usd",
        "display_order",
        scenario.amount_type(F.col("reporting_month")).alias("amount_type"),
    )


def monthly_pivot(report_lines: DataFrame, lines: LineBook) -> DataFrame:
    """One column per line, zero where a month has none."""
    sums = [
        F.expr(
            f"sum(CASE WHEN reporting_line = {text_literal(x.reporting_line)} "
            f"THEN signed_amount_usd ELSE 0 END) AS {x.column}"
        )
        for x in lines
    ]
    return report_lines.groupBy("entity_id", "reporting_month", "amount_type").agg(*sums)


def net_column(section: str) -> str:
    return f"net_{section.lower()}_cash_flow"


def section_nets(pivoted: DataFrame, lines: LineBook) -> DataFrame:
    """Line columns grouped by section, each section's net, and the net change."""
    columns = []
    for section in SECTIONS:
        members = [x.column for x in lines.in_section(section)]
        columns += [*members, f"{_total(members)} AS {net_column(section)}"]
    net_change = _total([x.column for x in lines])
    return pivoted.selectExpr(
        "entity_id",
        "reporting_month",
        "amount_type",
        *columns,
        f"{net_change} AS net_change_in_cash",
    )


def _total(columns: list[str]) -> str:
    return " + ".join(columns) or "CAST(0 AS BIGINT)"


def roll_forward(nets: DataFrame, opening: DataFrame) -> DataFrame:
    """Beginning and ending cash.

    The window runs per entity over monthly rows, never over ledger rows. An
    entity without an opening record keeps NULL balances.
    """
    earlier = (
        Window.partitionBy("entity_id")
        .orderBy("reporting_month")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    moved = F.coalesce(F.sum("net_change_in_cash").over(earlier), F.lit(0))
    start = opening.select("entity_id", "available_balance_usd")
    return (
        nets.withColumn("_moved", moved)
        .join(start, "entity_id", "left")
        .withColumn("beginning_cash", F.col("available_balance_usd") + F.col("_moved"))
        .withColumn("ending_cash", F.col("beginning_cash") + F.col("net_change_in_cash"))
        .select(*nets.columns, "beginning_cash", "ending_cash")
    )


def monthly_summary(report_lines: DataFrame, opening: DataFrame, lines: LineBook) -> DataFrame:
    return roll_forward(section_nets(monthly_pivot(report_lines, lines), lines), opening)


def final_balance(summary: DataFrame) -> DataFrame:
    return summary.groupBy("entity_id").agg(
        F.max("reporting_month").alias("reporting_month"),
        F.max_by("ending_cash", "reporting_month").alias("ending_cash"),
    )


def cash_measures(ledger: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Cash inflow, outflow and net movement by the given dimensions."""
    amount, direction = F.col("signed_amount_usd"), F.col("cash_direction")
    return ledger.groupBy(*by).agg(
        F.sum(F.when(direction == "inflow", amount).otherwise(0)).alias("cash_inflow"),
        F.sum(F.when(direction == "outflow", amount).otherwise(0)).alias("cash_outflow"),
        F.sum(amount).alias("net_cash_movement"),
        F.count("*").alias("n_transactions"),
    )


def rollup_by(ledger: DataFrame, dimension: str) -> DataFrame:
    """Signed total per value of a dimension; sections come with their order."""
    total = ledger.groupBy(dimension).agg(F.sum("signed_amount_usd").alias("signed_amount_usd"))
    if dimension == "cash_flow_section":
        total = total.withColumn("section_order", section_rank(F.col(dimension)))
    return total
