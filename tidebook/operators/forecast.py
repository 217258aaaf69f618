"""Drivers and projected months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import month_label, text_literal
from tidebook.operators.ledger import TRANSACTION_COLUMNS
from tidebook.plans.growth import FACTOR, Growth
from tidebook.plans.lines import LAST_MONTH, RECURRING, Line, LineBook
from tidebook.plans.scenario import TRAILING_MONTHS, Scenario

# Fixed values of the published rows.
FORECAST_SYSTEM = "Forecast"
SCENARIO_FILE = "forecast_scenario.csv"
PLAN_FILE = "plan_schedule.csv"


def period_spine(spark: SparkSession, scenario: Scenario, which: str = "all") -> DataFrame:
    months = spark.range(1).select(F.explode(scenario.months(which)).alias("reporting_month"))
    return months.withColumn("amount_type", scenario.amount_type(F.col("reporting_month")))


def entity_profile(
    totals: DataFrame, scenario: Scenario, lines: LineBook, roster: DataFrame | None = None
) -> DataFrame:
    """One row per entity: its closed amounts and what each line's driver implies.

    Recurring lines: the closing months' sum over a fixed divisor, so a month
    without activity counts as zero. Last-month lines: the total of the line's
    own last active month. A driver is NULL where there is nothing to go by.

    ``totals`` are closed monthly totals; ``roster`` adds entities without
    activity. Everything after this row is a projection of it, so forecast and
    report need one pass over the ledger and one shuffle by entity. The map
    holds at most closed months × lines entries, both known beforehand, which
    also bounds what any one entity brings to a partition.
    """
    cells = totals.select("entity_id", "reporting_month", "reporting_line", "signed_amount_usd")
    if roster is not None:
        # Roster rows are NULL but for the entity.
        cells = cells.unionByName(roster.select("entity_id"), allowMissingColumns=True)
    monthly = (
        cells.repartition("entity_id")
        .groupBy("entity_id", "reporting_month", "reporting_line")
        .agg(F.sum("signed_amount_usd").alias("signed_amount_usd"))
    )
    in_report = lines.knows(F.col("reporting_line")) & scenario.closed(F.col("reporting_month"))
    entry = F.expr("struct(struct(reporting_month, reporting_line) AS key, signed_amount_usd AS value)")
    return monthly.groupBy("entity_id").agg(
        F.map_from_entries(F.collect_list(F.when(in_report, entry))).alias("closed_amounts"),
        *[
            F.expr(rule(scenario, f"reporting_line = {text_literal(x.reporting_line)}")).alias(x.column)
            for x, rule in ((x, DRIVER_RULES.get(x.driver_kind)) for x in lines)
            if rule is not None
        ],
    )


def _trailing_average(scenario: Scenario, here: str) -> str:
    trailing = (
        f"reporting_month BETWEEN DATE '{scenario.first_trailing_month}' "
        f"AND DATE '{scenario.last_closed_month}'"
    )
    total = f"sum(signed_amount_usd) FILTER (WHERE {here} AND {trailing})"
    return f"CAST(round({total} / {TRAILING_MONTHS}) AS BIGINT)"


def _last_active_total(scenario: Scenario, here: str) -> str:
    return f"max_by(signed_amount_usd, reporting_month) FILTER (WHERE {here})"


# Lines of any other kind have no driver and wait for the plan.
DRIVER_RULES = {RECURRING: _trailing_average, LAST_MONTH: _last_active_total}


def _driver(line: Line) -> str:
    return line.column if line.driver_kind in DRIVER_RULES else "CAST(NULL AS BIGINT)"


def _grown(line: Line, scenario: Scenario, growth: Growth) -> str:
    """The driver in each open month; in closed months as it is."""
    driver = _driver(line)
    if line.driver_kind != RECURRING or not growth.rates.get(line.reporting_line):
        return driver
    factors = growth.factors(line.reporting_line, scenario.forecast_months)
    listed = ", ".join(f"CAST({f} AS {FACTOR})" for f in factors)
    last = scenario.last_closed_month
    ahead = f"(year(reporting_month) - {last.year}) * 12 + month(reporting_month) - {last.month}"
    # At most 18 digits, so that the product keeps every decimal place; a larger driver fails.
    grown = f"CAST(bround(CAST({driver} AS DECIMAL(18,0)) * try_element_at(array({listed}), {ahead}), 0) AS BIGINT)"
    return f"if(reporting_month > DATE '{last}', {grown}, {driver})"


LINE_FIELDS = (
    "cash_flow_section",
    "business_activity",
    "reporting_line",
    "cash_direction",
    "id_prefix",
    "driver_kind",
)


def _each_line(lines: LineBook, **values) -> Column:
    """Rows of one struct per line; ``values`` are functions from a line to an expression."""
    structs = []
    for line in lines:
        fields = [f"{text_literal(getattr(line, f))} AS {f}" for f in LINE_FIELDS]
        fields += [f"{value(line)} AS {name}" for name, value in values.items()]
        structs.append(f"struct({', '.join(fields)})")
    return F.expr(f"inline(array({', '.join(structs)}))")


def line_drivers(profile: DataFrame, lines: LineBook) -> DataFrame:
    """One row per entity and line with its driver amount, NULL where it has none."""
    return profile.select("entity_id", _each_line(lines, driver_amount_usd=_driver))


def calendar_cells(
    profile: DataFrame,
    scenario: Scenario,
    lines: LineBook,
    plan: DataFrame | None = None,
    which: str = "all",
    growth: Growth | None = None,
) -> DataFrame:
    """One row per entity, month and line: closed amount, or projection, or zero.

    A plan row replaces the driver of its entity, month and line. Plan rows that
    match no open cell have no effect; ``unused_overrides`` lists them. Growth is
    that of run rates; it changes neither plan rows nor other lines.
    """
    month = F.col("reporting_month")

    def driver(line):
        return _driver(line) if growth is None else _grown(line, scenario, growth)

    def closed_amount(line):
        name = text_literal(line.reporting_line)
        return f"element_at(closed_amounts, struct(reporting_month, {name} AS reporting_line))"

    cells = profile.select("*", F.explode(scenario.months(which)).alias("reporting_month")).select(
        "entity_id",
        "reporting_month",
        _each_line(lines, closed_amount_usd=closed_amount, driver_amount_usd=driver),
    )
    if plan is None:
        cells = cells.withColumn("plan_amount_usd", F.lit(None).cast("bigint"))
    else:
        overrides = plan.filter(scenario.is_open(month)).select(
            "entity_id",
            "reporting_month",
            "reporting_line",
            F.col("amount_usd").cast("bigint").alias("plan_amount_usd"),
        )
        cells = cells.join(overrides, ["entity_id", "reporting_month", "reporting_line"], "left")
    projected = F.coalesce("plan_amount_usd", "driver_amount_usd", F.lit(0))
    return cells.withColumn(
        "signed_amount_usd",
        F.when(scenario.is_open(month), projected)
        .otherwise(F.coalesce("closed_amount_usd", F.lit(0)))
        .cast("bigint"),
    )


def project_forecast(
    profile: DataFrame,
    scenario: Scenario,
    lines: LineBook,
    plan: DataFrame | None = None,
    growth: Growth | None = None,
) -> DataFrame:
    """Forecast ledger: one transaction per entity, line and open month.

    Ids are unique within an entity.
    """
    month = F.col("reporting_month")
    return (
        calendar_cells(profile, scenario, lines, plan, "forecast", growth)
        .select(
            "*",
            F.concat_ws("-", "id_prefix", month_label(month)).alias("transaction_id"),
            F.lit(FORECAST_SYSTEM).alias("source_system"),
            F.when(F.col("plan_amount_usd").isNotNull(), PLAN_FILE)
            .otherwise(SCENARIO_FILE)
            .alias("source_file"),
            F.col("reporting_line").alias("source_category"),
            F.lit("").alias("vendor"),
            month.alias("cash_date"),
        )
        .select("entity_id", *TRANSACTION_COLUMNS)
    )


def unused_overrides(
    plan: DataFrame, roster: DataFrame, scenario: Scenario, lines: LineBook
) -> DataFrame:
    """Plan rows outside the open months, or for an unknown line or entity."""
    month = F.col("reporting_month")
    usable = (
        scenario.is_open(month)
        & (month <= F.lit(scenario.last_month))
        & (F.trunc(month, "month") == month)
        & lines.knows(F.col("reporting_line"))
    )
    known = roster.select("entity_id").distinct().withColumn("_known", F.lit(True))
    return (
        plan.join(known, "entity_id", "left")
        .filter(~F.coalesce(usable & F.col("_known"), F.lit(False)))
        .select("entity_id", "reporting_month", "reporting_line", "amount_usd")
    )
