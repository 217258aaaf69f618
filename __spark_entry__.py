"""

Every query reads whole driver tables. Amounts with cents leave as whole cents.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_statements
from tidebook.functions import cents, status_code
from tidebook.operators import backtest, checks, forecast, ledger, lineage, lookup, reconcile, report, what_if
from tidebook.operators.what_if import Change, WhatIf
from tidebook.plans import staged_run
from tidebook.plans.growth import Growth
from tidebook.plans.lines import LAST_MONTH, RECURRING
from tidebook.session import cut_lineage, scratch
from tidebook.sources import quarantine, trade
from tidebook.sources.extract import UNKNOWN_ENTITY, kept_records, priced_records
from tidebook.sources.files import file_order, read_csv, read_csv_placed, write_csv, write_table
from tidebook.sources.ids import literal_ids

SCENARIO, LINES = trade.SCENARIO, trade.LINES
VENDOR_SOURCES = (trade.OPERATING, trade.CAPITAL, trade.CREDITS)


class Book:
    """The operators bound to one folder of driver tables; all frames are lazy.

    ``rules`` replace the mapping, ``facts`` the raw tables of those names.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, planned: bool = False, rules=None, **facts):
        self.spark = spark
        self.sf_dir = sf_dir
        self.plan = trade.plan(spark, sf_dir) if planned else None
        self.rules, self.facts = rules, facts

    @cached_property
    def extracts(self):
        return trade.extracts(self.spark, self.sf_dir, **self.facts)

    @cached_property
    def mapping(self) -> DataFrame:
        return self.rules if self.rules is not None else trade.mapping(self.spark)

    @cached_property
    def full_ledger(self) -> DataFrame:
        return ledger.build_ledger(self.extracts, self.mapping)

    @cached_property
    def actuals(self) -> DataFrame:
        return ledger.build_ledger(self.extracts, self.mapping, closed_only=SCENARIO)

    @cached_property
    def opening(self) -> DataFrame:
        return ledger.opening_balance(trade.bank(self.spark, self.sf_dir))

    @cached_property
    def totals(self) -> DataFrame:
        return ledger.monthly_totals(self.actuals)

    @cached_property
    def profile(self) -> DataFrame:
        return forecast.entity_profile(self.totals, SCENARIO, LINES, roster=self.opening)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast.project_forecast(self.profile, SCENARIO, LINES, self.plan)

    def cells(self, which: str = "all") -> DataFrame:
        return forecast.calendar_cells(self.profile, SCENARIO, LINES, self.plan, which)

    @cached_property
    def lines(self) -> DataFrame:
        return report.monthly_lines(self.cells(), SCENARIO, LINES)

    @cached_property
    def summary(self) -> DataFrame:
        return report.monthly_summary(self.lines, self.opening, LINES)

    @cached_property
    def cash(self) -> DataFrame:
        """Totals of both ledgers, the far side of every reconciliation."""
        return self.totals.unionByName(ledger.monthly_totals(self.forecast))


def book_of(spark: SparkSession, sf_dir: str, planned: bool = False) -> Book:
    """Made anew for each query, so that each lists the files that are there then."""
    return Book(spark, sf_dir, planned)


def in_cents(frame: DataFrame, *columns: str) -> DataFrame:
    """Money columns ``x`` as ``x_cents``."""
    picked = [
        cents(F.col(c)).alias(f"{c}_cents") if c in columns else F.col(c) for c in frame.columns
    ]
    return frame.select(*picked)


def kept_status_counts(spark, sf_dir):
    return in_cents(ledger.status_counts(trade.extracts(spark, sf_dir)), "amount")


def canonical_ledger(spark, sf_dir):
    return in_cents(kept_records(trade.extracts(spark, sf_dir)), "amount")


def mapped_signed_ledger(spark, sf_dir):
    return in_cents(book_of(spark, sf_dir).full_ledger, "signed_amount")


def unmapped_categories(spark, sf_dir):
    book = book_of(spark, sf_dir)
    mapping = book.mapping.filter(F.col("category") != "PROMO")
    return checks.unmapped_categories(ledger.build_ledger(book.extracts, mapping))


def repeated_mapping_keys(spark, sf_dir):
    """A second rule for every type that parts are sold under, next to the mapping's."""
    types = trade.read(spark, sf_dir, "part").select(F.col("p_type").alias("category")).distinct()
    extra = types.select(F.lit(trade.OPERATING).alias("source"), "category")
    rules = trade.mapping(spark).select("source", "category").unionByName(extra)
    return checks.repeated_rules(rules)


def duplicate_line_ids(spark, sf_dir):
    """Order line numbers are not unique; grouped as numbers, named afterwards. Blank ids are audited apart."""
    items = trade.read(spark, sf_dir, "lineitem").filter(status_code(F.col("l_linestatus")) == "F")
    named = items.filter("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    return checks.repeated_ids(named, "l_orderkey", "l_linenumber").selectExpr(
        "concat('LIN-', l_orderkey, '-', l_linenumber) AS transaction_id", "n_rows"
    )


def missing_counterparty_counts(spark, sf_dir):
    rows = book_of(spark, sf_dir).full_ledger
    blank_vendor = F.coalesce(F.trim("vendor"), F.lit("")) == ""
    return rows.groupBy("source").agg(
        F.count("*").alias("n_records"),
        F.count(F.when(blank_vendor, 1)).alias("blank_vendors"),
        F.count(F.when(checks.missing_vendor(VENDOR_SOURCES), 1)).alias("violations"),
    )


def out_of_window_rejects(spark, sf_dir):
    _, rejects = ledger.close_actuals(book_of(spark, sf_dir).full_ledger, SCENARIO)
    return rejects.groupBy("source", "reporting_month").agg(
        F.count("*").alias("n_records"),
        F.sum("signed_amount_usd").alias("signed_amount_usd"),
    )


def closed_actuals(spark, sf_dir):
    actuals, _ = ledger.close_actuals(book_of(spark, sf_dir).full_ledger, SCENARIO)
    return ledger.transactions(actuals)


def opening_by_entity(spark, sf_dir):
    return book_of(spark, sf_dir).opening


def control_totals(spark, sf_dir):
    return in_cents(checks.control_totals(book_of(spark, sf_dir).actuals), "amount")


def raw_totals(spark, sf_dir):
    """Control totals taken straight from the raw tables, past the ledger."""
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    items = (
        trade.read(spark, sf_dir, "lineitem")
        .filter((status_code(F.col("l_linestatus")) == "F") & SCENARIO.closed(F.col("l_shipdate")))
        .join(trade.read(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"), "left")
        .selectExpr(
            f"CASE WHEN l_returnflag = 'R' THEN 'Financing' "
            f"WHEN p_type IN {trade.CAPITAL_TYPES} THEN 'Investing' "
            f"ELSE 'Operating' END AS cash_flow_section",
            "if(l_returnflag <=> 'R', 'inflow', 'outflow') AS cash_direction",
            f"if(l_returnflag <=> 'R', {price}, -{price}) AS signed_amount",
        )
    )
    orders = (
        trade.read(spark, sf_dir, "orders")
        .filter((status_code(F.col("o_orderstatus")) == "F") & SCENARIO.closed(F.col("o_orderdate")))
        .selectExpr(
            "'Operating' AS cash_flow_section",
            "'inflow' AS cash_direction",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS signed_amount",
        )
    )
    return checks.control_totals(items.unionByName(orders)).withColumnRenamed("amount", "expected_amount")


def agreed_opening(spark, sf_dir):
    """What each nation's customers hold, added up in cents."""
    held = F.sum((F.col("c_acctbal").cast("decimal(18,2)") * 100).cast("bigint"))
    nation = F.coalesce(F.col("c_nationkey").cast("string"), F.lit(UNKNOWN_ENTITY)).alias("entity_id")
    per_nation = trade.read(spark, sf_dir, "customer").groupBy(nation).agg(held.alias("cents"))
    return per_nation.selectExpr(
        "entity_id", "CAST(bround(CAST(cents AS DECIMAL(30,2)) / 100, 0) AS BIGINT) AS expected_amount"
    )


def closed_months(closed: DataFrame) -> DataFrame:
    """What each entity and line moved in each closed month; ``closed`` are transactions or sums of them."""
    return closed.groupBy("entity_id", "reporting_line", "reporting_month").agg(F.sum("signed_amount_usd").alias("total"))


def driver_cells(book: Book, monthly: DataFrame | None = None) -> DataFrame:
    """Forecast cells from closed transactions, without the profile that forecasts are made of."""
    monthly = closed_months(book.actuals) if monthly is None else monthly
    kinds = {kind: [x.reporting_line for x in LINES if x.driver_kind == kind] for kind in (RECURRING, LAST_MONTH)}
    closing = F.col("reporting_month") >= F.lit(SCENARIO.first_trailing_month)
    rates = (
        monthly.filter(F.col("reporting_line").isin(kinds[RECURRING]) & closing)
        .groupBy("entity_id", "reporting_line")
        .agg(F.round(F.sum("total") / 3).cast("bigint").alias("driver"))
    )
    latest = F.max(F.struct("reporting_month", "total"))["total"]
    last = (
        monthly.filter(F.col("reporting_line").isin(kinds[LAST_MONTH]))
        .groupBy("entity_id", "reporting_line")
        .agg(latest.alias("driver"))
    )
    entities = book.opening.select("entity_id").unionByName(monthly.select("entity_id")).distinct()
    names = F.explode(F.array(*[F.lit(x.reporting_line) for x in LINES])).alias("reporting_line")
    months = F.explode(SCENARIO.months("forecast")).alias("reporting_month")
    grid = entities.select("entity_id", names).select("entity_id", "reporting_line", months)
    planned = book.plan.select(
        "entity_id", "reporting_month", "reporting_line", F.col("amount_usd").alias("planned")
    )
    return (
        grid.join(rates.unionByName(last), ["entity_id", "reporting_line"], "left")
        .join(planned, ["entity_id", "reporting_month", "reporting_line"], "left")
        .withColumn("signed_amount_usd", F.coalesce("planned", "driver", F.lit(0)).cast("bigint"))
        .select("entity_id", "reporting_month", "reporting_line", "signed_amount_usd")
    )


def agreed_net_change(book: Book, monthly: DataFrame) -> DataFrame:
    """Closed transactions and forecast cells of each entity, added up."""
    moves = monthly.select("entity_id", F.col("total").alias("signed_amount_usd")).unionByName(
        driver_cells(book, monthly).select("entity_id", "signed_amount_usd")
    )
    return moves.groupBy("entity_id").agg(F.sum("signed_amount_usd").alias("expected_amount"))


def agreed_balance(opening: DataFrame, net_change: DataFrame) -> DataFrame:
    both = opening.unionByName(net_change).groupBy("entity_id")
    return both.agg(F.sum("expected_amount").alias("expected_amount"))


def control_totals_agree(spark, sf_dir):
    """Ledger totals against the raw tables'."""
    totals = checks.control_totals(book_of(spark, sf_dir).actuals)
    compared = checks.compare_totals(totals, raw_totals(spark, sf_dir))
    return in_cents(compared, "amount", "expected_amount")


def control_totals_unexpected(spark, sf_dir):
    """An agreement that leaves a group out: the ledger's group has nothing to agree with."""
    agreed = raw_totals(spark, sf_dir).filter("cash_flow_section <> 'Financing'")
    compared = checks.compare_totals(checks.control_totals(book_of(spark, sf_dir).actuals), agreed)
    return in_cents(compared, "amount", "expected_amount")


def repeated_dimension_keys(spark, sf_dir):
    return checks.repeated_dimension_keys(trade.dimension_keys(spark, sf_dir)).drop("sample_key")


def ids_with_null_parts(spark, sf_dir):
    """The id audit where order lines numbered 4 have lost their number."""
    items = trade.read(spark, sf_dir, "lineitem")
    items = items.withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(4)))
    extracts = trade.extracts(spark, sf_dir, lineitem=items)
    return lineage.id_audit(ledger.build_ledger(extracts, trade.mapping(spark)))


def forecast_months(spark, sf_dir):
    """The horizon of every nation."""
    nations = trade.read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("entity_id")
    )
    month = F.explode(SCENARIO.months("all")).alias("reporting_month")
    return nations.select("entity_id", month).withColumn(
        "amount_type", SCENARIO.amount_type(F.col("reporting_month"))
    )


def _drivers_of(spark, sf_dir, kind):
    drivers = forecast.line_drivers(book_of(spark, sf_dir).profile, LINES)
    return drivers.filter((F.col("driver_kind") == kind) & F.col("driver_amount_usd").isNotNull()).select(
        "entity_id", "reporting_line", F.col("driver_amount_usd").alias("amount_usd")
    )


def run_rate_drivers(spark, sf_dir):
    return _drivers_of(spark, sf_dir, RECURRING)


def last_active_month_driver(spark, sf_dir):
    return _drivers_of(spark, sf_dir, LAST_MONTH)


def forecast_no_plan(spark, sf_dir):
    return book_of(spark, sf_dir).forecast


def forecast_with_plan(spark, sf_dir):
    return book_of(spark, sf_dir, planned=True).forecast


def unused_overrides(spark, sf_dir):
    book = book_of(spark, sf_dir, planned=True)
    return forecast.unused_overrides(book.plan, book.opening, SCENARIO, LINES)


def forecast_cardinality_and_unique(spark, sf_dir):
    ids = book_of(spark, sf_dir).forecast.select("entity_id", "transaction_id")
    per_id = ids.groupBy("entity_id", "transaction_id").agg(F.count("*").alias("n"))
    return per_id.groupBy("entity_id").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.when(F.col("n") > 1, 1)).alias("repeated_ids"),
        F.lit(SCENARIO.forecast_months * len(LINES)).cast("bigint").alias("expected_rows"),
    )


def monthly_lines_all(spark, sf_dir):
    return book_of(spark, sf_dir).lines


def monthly_lines_with_plan(spark, sf_dir):
    return book_of(spark, sf_dir, planned=True).lines


def actual_lines(spark, sf_dir):
    return monthly_lines_all(spark, sf_dir).filter(F.col("amount_type") == "Actual")


def forecast_lines(spark, sf_dir):
    return monthly_lines_all(spark, sf_dir).filter(F.col("amount_type") == "Forecast")


def monthly_pivot(spark, sf_dir):
    return report.monthly_pivot(monthly_lines_all(spark, sf_dir), LINES)


def section_nets(spark, sf_dir):
    nets = report.section_nets(monthly_pivot(spark, sf_dir), LINES)
    return nets.drop(*[x.column for x in LINES])


def balance_rollforward(spark, sf_dir):
    return book_of(spark, sf_dir).summary


def balance_rollforward_with_plan(spark, sf_dir):
    return book_of(spark, sf_dir, planned=True).summary


def final_balance_by_entity(spark, sf_dir):
    return report.final_balance(book_of(spark, sf_dir).summary)


def recon_line(spark, sf_dir):
    book = book_of(spark, sf_dir)
    return reconcile.reconcile_lines(book.lines, book.cash)


def recon_activity(spark, sf_dir):
    book = book_of(spark, sf_dir)
    return reconcile.reconcile_activities(book.lines, book.cash)


def recon_section(spark, sf_dir):
    book = book_of(spark, sf_dir)
    return reconcile.reconcile_sections(book.summary, book.cash)


def unknown_lines(spark, sf_dir):
    return checks.unknown_lines(book_of(spark, sf_dir).totals, LINES.without("Equipment paid"))


def rollforward_identity(spark, sf_dir):
    return checks.roll_forward_rows(book_of(spark, sf_dir).summary)


def period_counts(spark, sf_dir):
    book = book_of(spark, sf_dir)
    return checks.period_counts(book.lines, book.summary)


def forecast_vs_driver(spark, sf_dir):
    book = book_of(spark, sf_dir, planned=True)
    open_lines = book.lines.filter(SCENARIO.is_open(F.col("reporting_month")))
    keys = ("entity_id", "reporting_month", "reporting_line")
    return reconcile.side_by_side(open_lines, driver_cells(book), keys)


def run_inputs(book: Book, expectations=staged_run.Expectations()) -> staged_run.Inputs:
    return staged_run.Inputs(
        extracts=book.extracts,
        mapping=book.mapping,
        bank=trade.bank(book.spark, book.sf_dir),
        scenario=SCENARIO,
        lines=LINES,
        vendor_sources=VENDOR_SOURCES,
        plan=book.plan,
        expectations=expectations,
        strict_window=False,
        dimensions=trade.dimension_keys(book.spark, book.sf_dir),
    )


def _checked(shared: Book, altered: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    """All gates over a book; ``altered`` changes the report lines after they were added up.

    The monthly tiers have several consumers each, so they are stored once. All totals of
    the closed ledger are added up from one pass over it.
    """
    spark, sf_dir = shared.spark, shared.sf_dir
    closed = cut_lineage(ledger.closed_sums(shared.actuals))
    book = Book(spark, sf_dir, planned=True)
    shared.opening = book.opening = cut_lineage(shared.opening)
    book.totals = cut_lineage(ledger.monthly_totals(closed))
    book.forecast = cut_lineage(book.forecast)
    book.lines = cut_lineage(altered(book.lines))
    tables = staged_run.Tables(
        run_id="",
        ledger=staged_run.with_window(shared.full_ledger, SCENARIO),
        totals=book.totals,
        opening=book.opening,
        forecast=book.forecast,
        lines=book.lines,
        summary=book.summary,
    )
    opening = cut_lineage(agreed_opening(spark, sf_dir))
    net_change = cut_lineage(agreed_net_change(shared, closed_months(closed)))
    agreed = staged_run.Expectations(
        control_totals=raw_totals(spark, sf_dir),
        opening=opening,
        net_change=net_change,
        final_balance=agreed_balance(opening, net_change),
    )
    found = staged_run.run_checks(run_inputs(shared, agreed), tables, closed=closed)
    return found.select("stage", "check_id", "ord", "violations", "observed", "expected", "passed")


def check_report(spark, sf_dir):
    """One row per gate, over ledger, forecast and report, with planned amounts."""
    return _checked(book_of(spark, sf_dir, planned=True))


def check_report_broken(spark, sf_dir):
    """The gates where a rule is missing, payments are repeated and a report line is altered."""
    items = trade.read(spark, sf_dir, "lineitem")
    repeated = items.unionByName(items.filter("l_orderkey % 1000 = 7"))
    rules = trade.mapping(spark).filter("category <> 'PROMO'")
    cell = (F.col("reporting_line") == "Overhead paid") & (F.col("reporting_month") == F.lit("2000-09-01").cast("date"))

    def altered(lines):
        return lines.withColumn("signed_amount_usd", F.col("signed_amount_usd") + F.when(cell, 1).otherwise(0))

    return _checked(Book(spark, sf_dir, planned=True, rules=rules, lineitem=repeated), altered)


def asked_ids(book: Book) -> DataFrame:
    """Ids to follow, as a written table: few, and of a size that the joins with them know."""
    return write_table(trade.example_ids(book.actuals), f"{scratch(book.spark, 'ids')}/asked")


def trace_ids(spark, sf_dir):
    """Every source record, followed to the report."""
    book = book_of(spark, sf_dir)
    traced = lineage.trace(book.extracts, book.mapping, book.actuals, book.lines)
    return in_cents(traced, "amount")


def trace_selected(spark, sf_dir):
    """The largest transaction of every entity and line, followed to the report."""
    book = book_of(spark, sf_dir)
    traced = lineage.trace_selected(book.extracts, book.mapping, SCENARIO, book.lines, asked_ids(book))
    return in_cents(traced, "amount")


def id_audit(spark, sf_dir):
    return lineage.id_audit(book_of(spark, sf_dir).full_ledger)


def id_presence(spark, sf_dir):
    book = book_of(spark, sf_dir)
    ids = asked_ids(book)
    chosen, closed = lineage.records_of_ids(book.extracts, book.mapping, SCENARIO, ids)
    return lineage.id_presence(ids, chosen, closed)


def ledger_rows_by_id(spark, sf_dir):
    """The asked-for ids read from a ledger tier that is laid out by id."""
    book = book_of(spark, sf_dir)
    index = lookup.write_index(book.full_ledger, f"{scratch(spark, 'by-id')}/ledger", buckets=32)
    asked = literal_ids(asked_ids(book))
    if asked is None:
        raise ValueError("more entities and lines than ids that a lookup takes")
    return in_cents(index.rows(spark, asked), "signed_amount")


def trace_line_sum(spark, sf_dir):
    book = book_of(spark, sf_dir)
    return lineage.trace_line_sums(book.actuals, book.lines, asked_ids(book))


def drilldown_month_line(spark, sf_dir):
    """What is behind the parts paid in the last closed month."""
    rows = lineage.drilldown(
        book_of(spark, sf_dir).full_ledger, SCENARIO.last_closed_month, "Parts paid"
    )
    return ledger.transactions(rows)


def _all_transactions(spark, sf_dir):
    book = book_of(spark, sf_dir, planned=True)
    return ledger.all_transactions(book.actuals, book.forecast, SCENARIO)


def drilldown_forecast_cell(spark, sf_dir):
    """What is behind the credit drawn in a planned month."""
    return lineage.drilldown(_all_transactions(spark, sf_dir), trade.PLANNED[1][0], "Credit drawn")


def cash_measures_by_type(spark, sf_dir):
    """Inflow, outflow and net movement by month, category and actual or forecast."""
    by = ("reporting_month", "cash_flow_section", "amount_type")
    return report.cash_measures(_all_transactions(spark, sf_dir), by)


def rollup_section(spark, sf_dir):
    return report.rollup_by(book_of(spark, sf_dir).actuals, "cash_flow_section")


def rollup_activity(spark, sf_dir):
    return report.rollup_by(book_of(spark, sf_dir).actuals, "business_activity")


def cash_measures(spark, sf_dir):
    by = ("reporting_month", "cash_flow_section")
    return report.cash_measures(book_of(spark, sf_dir).actuals, by)


def cash_by_month_and_line(spark, sf_dir):
    by = ("entity_id", "reporting_month", "reporting_line")
    return report.cash_measures(book_of(spark, sf_dir).actuals, by)


def published_summary(spark, sf_dir):
    """The summary as a full run stages, checks and publishes it."""
    inputs = run_inputs(book_of(spark, sf_dir, planned=True))
    folder = scratch(spark, "run")
    tables = staged_run.run(spark, inputs, folder)
    published = staged_run.published_run(spark, folder)
    return spark.read.schema(tables.summary.schema).parquet(f"{published}/cash_summary")


def lines_through_csv(spark, sf_dir):
    """Monthly lines written as ordered CSV and read back with declared columns."""
    lines = book_of(spark, sf_dir).lines
    folder = f"{scratch(spark, 'run')}/lines"
    write_csv(lines, folder, "reporting_month", "entity_id", "display_order")
    declared = ", ".join(f"{name} {kind}" for name, kind in lines.dtypes)
    return read_csv(spark, folder, declared)


# Texts as a feed might bring them: by key, some values cannot be read.
ORDER_FEED = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2), o_orderdate date"
ORDER_TEXT = (
    "CAST(o_orderkey AS STRING) AS o_orderkey",
    "CASE WHEN o_orderkey % 211 = 17 THEN concat('C', o_custkey) ELSE CAST(o_custkey AS STRING) END AS o_custkey",
    "o_orderstatus",
    "CASE WHEN o_orderkey % 97 = 5 THEN 'n/a' WHEN o_orderkey % 97 = 6 THEN '  ' "
    "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS o_totalprice",
    "CASE WHEN o_orderkey % 89 = 3 THEN concat(date_format(o_orderdate, 'yyyy'), '-13-01') "
    "WHEN o_orderkey % 89 = 4 THEN date_format(o_orderdate, 'yyyy') "
    "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS o_orderdate",
)
ITEM_FEED = "l_orderkey bigint, l_linenumber int, l_quantity decimal(18,2), l_extendedprice decimal(18,2), l_shipdate date"
ITEM_TEXT = (
    "CAST(l_orderkey AS STRING) AS l_orderkey",
    "CAST(l_linenumber AS STRING) AS l_linenumber",
    "CASE WHEN l_orderkey % 101 = 7 THEN '1O' ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) END AS l_quantity",
    "CASE WHEN l_orderkey % 103 = 7 THEN concat('USD ', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)) "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS l_extendedprice",
    "date_format(l_shipdate, 'yyyy-MM-dd') AS l_shipdate",
)


def _feeds(spark, sf_dir):
    orders = trade.read(spark, sf_dir, "orders").selectExpr(*ORDER_TEXT)
    items = trade.read(spark, sf_dir, "lineitem").selectExpr(*ITEM_TEXT)
    return (
        quarantine.split_readable(orders, ORDER_FEED, "orders", "concat('ORD-', o_orderkey)"),
        quarantine.split_readable(items, ITEM_FEED, "lineitem", "concat('LIN-', l_orderkey, '-', l_linenumber)"),
    )


def quarantined_records(spark, sf_dir):
    """Values of two text feeds that cannot be read, with record, column and reason."""
    return quarantine.all_rejects(*_feeds(spark, sf_dir))


def records_past_quarantine(spark, sf_dir):
    """What is left of the feeds: typed records, their amounts, and days without a value."""
    orders, items = (split.valid for split in _feeds(spark, sf_dir))
    both = orders.selectExpr("'orders' AS feed", "o_totalprice AS amount", "o_orderdate AS day").unionByName(
        items.selectExpr("'lineitem' AS feed", "l_extendedprice AS amount", "l_shipdate AS day")
    )
    by_month = both.groupBy("feed", F.trunc("day", "month").alias("month")).agg(
        F.count("*").alias("n_records"), F.count("amount").alias("n_amounts"), F.sum("amount").alias("amount")
    )
    return in_cents(by_month, "amount")


WHAT_IFS = (
    WhatIf("as is"),
    WhatIf("more orders", {"Order cash received": Change(quantity=Decimal("1.1"))}),
    WhatIf(
        "dearer parts",
        {
            "Order cash received": Change(price=Decimal("0.85")),
            "Parts paid": Change(quantity=Decimal("1.0375"), price=Decimal("1.2")),
        },
    ),
    WhatIf("list price", {"Parts paid": Change(quantity=Decimal("0.5"), unit_price=Decimal("1234.5"))}),
)


def _what_ifs(spark, sf_dir):
    book = book_of(spark, sf_dir, planned=True)
    quantities = what_if.quantity_drivers(book.extracts, book.mapping, SCENARIO, LINES)
    return book, what_if.what_if_lines(book.profile, SCENARIO, LINES, WHAT_IFS, book.plan, quantities)


def what_if_lines(spark, sf_dir):
    """Monthly lines under other quantities and prices, every what-if in one plan."""
    return _what_ifs(spark, sf_dir)[1]


def what_if_balances(spark, sf_dir):
    book, changed = _what_ifs(spark, sf_dir)
    return what_if.what_if_balances(changed, book.opening)


GROWTH = Growth({"Order cash received": Decimal("0.015"), "Overhead paid": Decimal("0.0325")})


def forecast_with_growth(spark, sf_dir):
    """The planned forecast where two run rates grow by month."""
    book = book_of(spark, sf_dir, planned=True)
    return forecast.project_forecast(book.profile, SCENARIO, LINES, book.plan, GROWTH)


def backtest_error(spark, sf_dir):
    """How far the forecasts of earlier closes were off, by line and distance."""
    cells = backtest.backtest(book_of(spark, sf_dir).profile, SCENARIO, LINES)
    return backtest.accuracy(cells, "close_month", "months_ahead", "reporting_line")


def amount_identity(spark, sf_dir):
    """Amounts against quantity times list price, one cent allowed."""
    priced = priced_records(trade.extracts(spark, sf_dir))
    judged = checks.amount_identity(priced, tolerance_cents=1)
    return judged.groupBy("source", "source_category", "outcome").agg(
        F.count("*").alias("n_records"), F.sum(F.abs("off_cents")).cast("bigint").alias("off_cents")
    )


def exported_order(spark, sf_dir):
    """Monthly lines from several CSV files, with the place of each row over all of them."""
    lines = book_of(spark, sf_dir).lines
    folder = f"{scratch(spark, 'run')}/lines"
    order = ("reporting_month", "entity_id", "display_order")
    write_csv(lines, folder, *order, parts=5)
    declared = ", ".join(f"{name} {kind}" for name, kind in lines.dtypes)
    placed = file_order(read_csv_placed(spark, folder, declared), *order)
    return placed.select(*order, "signed_amount_usd", "rank", "in_order")


def records_by_file(spark, sf_dir):
    """Kept records by the file that Spark read them from."""
    records = kept_records(trade.extracts_with_files(spark, sf_dir))
    by_file = records.groupBy("source_file", "source").agg(
        F.count("*").alias("n_records"), F.sum("amount").alias("amount")
    )
    return in_cents(by_file, "amount")


def scenario_checks(spark, sf_dir):
    """The scenario rules over one small table per nation: none, one or two rows, some of them wrong."""
    nation = trade.read(spark, sf_dir, "nation")
    groups = nation.select(F.col("n_nationkey").cast("string").alias("entity_id"))
    proposed = nation.filter("n_nationkey % 3 > 0").selectExpr(
        "CAST(n_nationkey AS STRING) AS entity_id",
        "explode(sequence(1, n_nationkey % 3)) AS row",
        "n_nationkey",
    )
    table = proposed.selectExpr(
        "entity_id",
        "CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 7 = 2 THEN '9+12' "
        "ELSE concat(n_nationkey - 4 + row, '+', if(n_nationkey % 4 = 0, 0, 12)) END AS scenario",
        "2000 AS fiscal_year",
        "n_nationkey - 4 + row AS actual_months",
        "if(n_nationkey % 4 = 0, 0, 12) AS forecast_months",
    )
    return checks.scenario_checks(table, groups).drop("sample_key")


QUERIES = (
    kept_status_counts,
    canonical_ledger,
    mapped_signed_ledger,
    unmapped_categories,
    repeated_mapping_keys,
    duplicate_line_ids,
    missing_counterparty_counts,
    out_of_window_rejects,
    closed_actuals,
    opening_by_entity,
    control_totals,
    control_totals_agree,
    control_totals_unexpected,
    repeated_dimension_keys,
    ids_with_null_parts,
    forecast_months,
    run_rate_drivers,
    last_active_month_driver,
    forecast_no_plan,
    forecast_with_plan,
    unused_overrides,
    forecast_cardinality_and_unique,
    monthly_lines_all,
    monthly_lines_with_plan,
    actual_lines,
    forecast_lines,
    monthly_pivot,
    section_nets,
    balance_rollforward,
    balance_rollforward_with_plan,
    final_balance_by_entity,
    recon_line,
    recon_activity,
    recon_section,
    unknown_lines,
    rollforward_identity,
    period_counts,
    forecast_vs_driver,
    check_report,
    check_report_broken,
    trace_ids,
    trace_selected,
    id_audit,
    id_presence,
    trace_line_sum,
    drilldown_month_line,
    drilldown_forecast_cell,
    cash_measures_by_type,
    rollup_section,
    rollup_activity,
    cash_measures,
    cash_by_month_and_line,
    published_summary,
    lines_through_csv,
    quarantined_records,
    records_past_quarantine,
    ledger_rows_by_id,
    what_if_lines,
    what_if_balances,
    forecast_with_growth,
    backtest_error,
    amount_identity,
    exported_order,
    records_by_file,
    scenario_checks,
)


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Monthly cash summary with balances, per entity."""
    return balance_rollforward(spark, sf_dir)


def _text_queries():
    """The registry of the text operators, or None where that subpackage is not installed."""
    try:
        from tidebook.llm import registry
    except ModuleNotFoundError as missing:
        if missing.name not in ("tidebook.llm", "tidebook.llm.registry", "corpus_pipeline"):
            raise
        return None
    except ImportError:
        # An emptied folder still imports as a namespace without a registry in it.
        if importlib.util.find_spec("tidebook.llm.registry"):
            raise
        return None
    return registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    texts = _text_queries()
    own = {query.__name__: query for query in QUERIES}
    return own | (texts.queries() if texts else {})


def oracle_sql() -> dict[str, str]:
    texts = _text_queries()
    return oracle_statements.statements() | (texts.oracle_sql() if texts else {})
