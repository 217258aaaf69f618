"""One full run: stage every tier, check it, and only then publish.

Tiers are exchanged as Parquet tables under a folder of this run, so each later
step, and every gate, reads small tables instead of repeating the ledger work,
and a lost executor costs no more than its tasks. Publishing appends one row to
a manifest; a run that fails a gate leaves the published one in place.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators import checks, forecast, ledger, lookup, report
from tidebook.plans.lines import LineBook
from tidebook.plans.scenario import Scenario
from tidebook.sources.constants import constant_frame
from tidebook.sources.extract import Extract, priced_records
from tidebook.sources.files import exists, write_csv, write_table

CLOSED, OUTSIDE = "closed", "outside"
MANIFEST_SCHEMA = "run_id string, published_at timestamp"


@dataclass(frozen=True)
class Expectations:
    """Agreed figures; each is optional.

    ``control_totals``: cash_flow_section, cash_direction, expected_amount.
    The others: entity_id, expected_amount.
    """

    control_totals: DataFrame | None = None
    opening: DataFrame | None = None
    net_change: DataFrame | None = None
    final_balance: DataFrame | None = None

    def missing(self) -> list[str]:
        """Figures that nobody agreed on; a run says so, and cannot check them."""
        return [name for name, frame in vars(self).items() if frame is None]


@dataclass(frozen=True)
class Inputs:
    extracts: list[Extract]
    mapping: DataFrame
    bank: DataFrame
    scenario: Scenario
    lines: LineBook
    vendor_sources: tuple[str, ...]
    plan: DataFrame | None = None
    expectations: Expectations = Expectations()
    strict_window: bool = True
    #: keys of the dimensions that the extracts join, by name
    dimensions: dict[str, DataFrame] | None = None
    #: whether all rows are of one entity, so that exports need not name it
    single_entity: bool = False
    #: values that could not be read, and how many records may have some
    rejects: DataFrame | None = None
    allowed_rejects: int = 0
    #: cents by which an amount may differ from quantity x price; None: not asked
    amount_tolerance_cents: int | None = None
    #: folders of the ledger tier laid out by id; 0: no such tier
    id_buckets: int = 0


@dataclass(frozen=True)
class Tables:
    run_id: str
    ledger: DataFrame
    totals: DataFrame
    opening: DataFrame
    forecast: DataFrame
    lines: DataFrame
    summary: DataFrame
    unreadable: DataFrame | None = None
    by_id: lookup.LedgerIndex | None = None

    @property
    def actuals(self) -> DataFrame:
        return self.ledger.filter(F.col("window") == CLOSED).drop("window")

    @property
    def rejects(self) -> DataFrame:
        return self.ledger.filter(F.col("window") == OUTSIDE).drop("window")


def with_window(full_ledger: DataFrame, scenario: Scenario) -> DataFrame:
    """Mark each event as inside the closed window or outside; no date is outside."""
    inside = F.coalesce(scenario.closed(F.col("cash_date")), F.lit(False))
    return full_ledger.withColumn("window", F.when(inside, CLOSED).otherwise(OUTSIDE))


def stage(inputs: Inputs, folder: str) -> Tables:
    """Write all tiers of one run under ``folder``."""
    scenario, book = inputs.scenario, inputs.lines
    full_ledger = with_window(ledger.build_ledger(inputs.extracts, inputs.mapping), scenario)
    staged_ledger = write_table(full_ledger, f"{folder}/ledger", "window", "reporting_month")
    closed = staged_ledger.filter(F.col("window") == CLOSED)
    unreadable = None if inputs.rejects is None else write_table(inputs.rejects, f"{folder}/unreadable_values")
    by_id = None
    if inputs.id_buckets:
        by_id = lookup.write_index(staged_ledger, f"{folder}/ledger_by_id", inputs.id_buckets)
    totals = write_table(ledger.monthly_totals(closed), f"{folder}/monthly_totals")
    opening = write_table(ledger.opening_balance(inputs.bank), f"{folder}/opening_balance")

    profile = forecast.entity_profile(totals, scenario, book, roster=opening)
    projected = write_table(
        forecast.project_forecast(profile, scenario, book, inputs.plan),
        f"{folder}/forecast_transactions",
    )
    entities = projected.select("entity_id").distinct()
    cells = report.cash_cells(totals, projected, report.zero_cells(entities, scenario, book))
    lines = write_table(
        report.monthly_lines(cells, scenario, book), f"{folder}/cash_flow_lines", "amount_type"
    )
    summary = write_table(
        report.monthly_summary(lines, opening, book), f"{folder}/cash_summary", "amount_type"
    )
    return Tables(
        folder.rsplit("/", 1)[-1], staged_ledger, totals, opening, projected, lines, summary, unreadable, by_id
    )


def run_checks(inputs: Inputs, tables: Tables, closed: DataFrame | None = None) -> DataFrame:
    """Every gate over the staged tables, one row per gate.

    ``closed`` is the closed ledger, or sums of it by section and direction, where that can
    be read for less than the staged one.
    """
    scenario, book, agreed = inputs.scenario, inputs.lines, inputs.expectations
    roster = tables.opening.select("entity_id").unionByName(tables.totals.select("entity_id"))
    roster = roster.distinct()
    cash = ledger_totals(tables)
    profile = forecast.entity_profile(tables.totals, scenario, book, roster=roster)
    expected_cells = forecast.calendar_cells(profile, scenario, book, inputs.plan, "forecast")
    entity_parts = [
        checks.opening_part(tables.opening, roster),
        checks.forecast_part(tables.forecast, roster, scenario, book),
        checks.line_part(tables.lines, scenario, book),
        checks.summary_part(tables.summary, scenario),
    ]
    if agreed.opening is not None:
        entity_parts.append(checks.opening_amount_part(tables.opening, agreed.opening))
    if agreed.net_change is not None:
        entity_parts.append(checks.net_change_part(tables.summary, agreed.net_change))
    if agreed.final_balance is not None:
        entity_parts.append(checks.final_balance_part(tables.summary, agreed.final_balance))
    parts = [
        checks.mapping_checks(ledger.mapping_rules(inputs.mapping)),
        checks.ledger_checks(tables.ledger, scenario, inputs.vendor_sources, inputs.strict_window),
        checks.entity_checks(*entity_parts),
        checks.cell_checks(tables.lines, tables.summary, cash, tables.forecast, expected_cells, scenario),
        checks.cash_checks(cash, scenario, book),
        checks.agreement_notice(inputs.mapping.sparkSession, agreed.missing()),
    ]
    if inputs.rejects is not None:
        unreadable = inputs.rejects if tables.unreadable is None else tables.unreadable
        parts.append(checks.reject_checks(unreadable, inputs.allowed_rejects))
    if inputs.amount_tolerance_cents is not None:
        priced = priced_records(inputs.extracts)
        parts.append(checks.amount_checks_by_record(priced, inputs.amount_tolerance_cents))
    if inputs.dimensions:
        parts.append(checks.dimension_checks(inputs.dimensions))
    if agreed.control_totals is not None:
        totals = checks.control_totals(tables.actuals if closed is None else closed)
        parts.append(checks.control_checks(totals, agreed.control_totals))
    if inputs.plan is not None:
        unused = forecast.unused_overrides(inputs.plan, roster, scenario, book)
        parts.append(checks.unused_override_checks(unused))
    return checks.combine(*parts)


def ledger_totals(tables: Tables) -> DataFrame:
    """Monthly totals of both ledgers: actual, and projected."""
    return tables.totals.unionByName(ledger.monthly_totals(tables.forecast))


def checked_scenario(spark: SparkSession, table: DataFrame, out_dir: str) -> Scenario:
    """The scenario of a table. One that breaks a rule leaves its gates as a run's checks, and nothing else."""
    found = checks.scenario_checks(table)
    if found.filter(~F.col("passed")).take(1):
        found = write_table(found.coalesce(1), f"{out_dir.rstrip('/')}/runs/{uuid.uuid4().hex}/checks")
        checks.enforce(found)
    return Scenario.from_frame(table)


def run(spark: SparkSession, inputs: Inputs, out_dir: str) -> Tables:
    """Stage, check, enforce, publish. Raises ``GateFailure`` and publishes nothing."""
    run_id = uuid.uuid4().hex
    folder = f"{out_dir.rstrip('/')}/runs/{run_id}"
    tables = stage(inputs, folder)
    found = write_table(run_checks(inputs, tables).coalesce(1), f"{folder}/checks")
    checks.enforce(found)
    manifest = constant_frame(spark, [(run_id,)], "run_id string").withColumn(
        "published_at", F.current_timestamp()
    )
    manifest.coalesce(1).write.mode("append").parquet(f"{out_dir.rstrip('/')}/published")
    return tables


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """Folder of the latest published run."""
    out_dir = out_dir.rstrip("/")
    if not exists(spark, f"{out_dir}/published"):
        return None
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_dir}/published")
    latest = manifest.agg(F.max_by("run_id", "published_at").alias("run_id")).first()["run_id"]
    return f"{out_dir}/runs/{latest}" if latest else None


def export_csv(tables: Tables, folder: str, single_entity: bool, single_file: bool = False) -> None:
    """The published tables as ordered CSV: ledgers, opening balance, lines, summaries.

    Only a run of one entity, by declaration of its binding, leaves the entity out.
    """
    out = folder.rstrip("/")
    outputs = {
        "cash_transactions": (ledger.transactions(tables.actuals), "cash_date", "transaction_id"),
        "forecast_transactions": (tables.forecast, "reporting_month", "transaction_id"),
        "opening_balance": (tables.opening, "account_id"),
    }
    for kind in ("Actual", "Forecast"):
        of_kind = F.col("amount_type") == kind
        lines, summary = tables.lines.filter(of_kind), tables.summary.filter(of_kind)
        outputs[f"{kind.lower()}_cash_flow_lines"] = (lines, "reporting_month", "display_order")
        outputs[f"{kind.lower()}_cash_summary"] = (summary, "reporting_month")
    for name, (frame, *order) in outputs.items():
        if single_entity:
            frame = frame.drop("entity_id")
        else:
            order = ["entity_id", *order]
        write_csv(frame, f"{out}/{name}", *order, single_file=single_file)
