"""Plans that should hold on a cluster, hot keys, and invariants of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidebook.operators import checks, forecast, ledger, lineage, report
from tidebook.sources import trade
from tidebook.sources.extract import Extract, kept_records

SCENARIO, LINES = trade.SCENARIO, trade.LINES


def executed(frame) -> str:
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def scans(plan: str, prefix: str) -> int:
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{prefix}", plan))


@pytest.mark.parametrize(
    "name",
    ["balance_rollforward_with_plan", "recon_line", "recon_activity", "recon_section", "period_counts"],
)
def test_one_pass_over_the_facts(spark, sf_dir, name):
    plan = executed(registry.queries()[name](spark, sf_dir))
    assert scans(plan, "l_") == scans(plan, "o_") == 1


# These run a whole write first; what they return is a plain file scan.
WRITTEN = {"published_summary", "lines_through_csv"}


@pytest.mark.parametrize("name", [q.__name__ for q in registry.QUERIES if q.__name__ not in WRITTEN])
def test_no_cross_joins_and_no_python_workers(spark, sf_dir, name):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", plan)
    # Only totals of totals may meet in one partition, never rows or windows.
    assert not re.search(r"Window.*\n.*Exchange SinglePartition", plan)


def test_closed_window_reaches_the_scan(spark, sf_dir):
    totals = ledger.monthly_totals(registry.Book(spark, sf_dir).actuals)
    plan = totals._jdf.queryExecution().toString()
    pushed = re.findall(r"GreaterThanOrEqual\((?:l_shipdate|o_orderdate),2000-01-01", plan)
    assert len(set(pushed)) == 2
    read = re.search(r"ReadSchema: struct<[^>]*l_\w+[^>]*", plan).group(0)
    assert "l_orderkey" not in read and "l_linenumber" not in read


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("kept_status_counts", {"orders", "lineitem", "part", "supplier", "customer"}),
        ("control_totals_agree", {"orders", "lineitem", "part", "supplier", "customer"}),
        ("cash_by_month_and_line", {"orders", "lineitem", "part", "supplier", "customer"}),
    ],
)
def test_only_needed_parties_are_joined(spark, sf_dir, name, tables):
    files = registry.queries()[name](spark, sf_dir).inputFiles()
    assert {re.search(r"(\w+)\.parquet", f).group(1) for f in files} == tables


def test_closed_only_equals_filtering_afterwards(spark, sf_dir):
    book = registry.Book(spark, sf_dir)
    after, rejects = ledger.close_actuals(book.full_ledger, SCENARIO)
    assert after.exceptAll(book.actuals).count() == 0
    assert after.count() == book.actuals.count()
    assert after.count() + rejects.count() == book.full_ledger.count()


def hot_extract(spark, n=30_000) -> Extract:
    """Payments of which a third share one supplier, one id and one entity."""
    hot = "id % 3 = 0"
    payments = spark.range(0, n, 1, 8).selectExpr(
        f"CASE WHEN {hot} THEN 7 ELSE id % 5000 END AS supplier",
        f"CASE WHEN {hot} THEN 'SAME' ELSE concat('P', id) END AS pay_id",
        "CAST(id % 900 AS DECIMAL(18,2)) + 0.5 AS paid",
        "DATE '2000-01-01' + CAST(id % 270 AS INT) AS paid_on",
        "CASE WHEN id % 2 = 0 THEN 'SMALL' ELSE 'STANDARD' END AS kind",
        "repeat(sha2(CAST(id AS STRING), 256), 4) AS memo",
    )
    suppliers = spark.range(0, 5000, 1, 4).selectExpr(
        "id AS s_id", "concat('Supplier ', id) AS s_title", "CASE WHEN id = 7 THEN 0 ELSE id % 40 END AS home"
    )
    return Extract(
        frame=payments.join(suppliers, F.expr("supplier = s_id"), "left"),
        source=f"'{trade.OPERATING}'",
        source_system="'AP'",
        source_file="memo",
        entity_id="home",
        record_id="pay_id",
        category="kind",
        vendor="s_title",
        event_date="paid_on",
        direction="'outflow'",
        amount="paid",
        status="'F'",
        kept_status="F",
    )


@pytest.fixture()
def shuffled_joins(spark):
    """As on tables too large to broadcast, with small skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_party_is_split_when_nothing_is_broadcast(spark, shuffled_joins):
    extract = hot_extract(spark)
    plan = executed(extract.kept_records())
    assert "SortMergeJoin(skew=true)" in plan
    assert "BroadcastHashJoin" not in plan


def test_hot_party_is_split_below_the_union_and_the_aggregation(spark, shuffled_joins):
    extracts = [hot_extract(spark), hot_extract(spark)]
    records = kept_records(extracts)
    totals = records.groupBy("entity_id", "source_category").agg(
        F.sum("amount").alias("amount"), F.max(F.length("source_file")).alias("widest")
    )
    assert executed(totals).count("SortMergeJoin(skew=true)") == 2
    assert totals.agg(F.sum("amount")).first()[0] == records.agg(F.sum("amount")).first()[0]


def test_hot_keys_give_whole_results(spark, shuffled_joins):
    n = 30_000
    rows = ledger.build_ledger([hot_extract(spark, n)], trade.mapping(spark))
    totals = ledger.monthly_totals(rows)
    assert rows.count() == n
    exact = rows.agg(F.sum("signed_amount_usd")).first()[0]
    assert totals.agg(F.sum("signed_amount_usd")).first()[0] == exact
    hot = totals.filter("entity_id = '0'").agg(F.sum("signed_amount_usd")).first()[0]
    direct = rows.filter("entity_id = '0'").agg(F.sum("signed_amount_usd")).first()[0]
    assert hot == direct
    gates = {
        r["check_id"]: r
        for r in checks.ledger_checks(rows, SCENARIO, (trade.OPERATING,)).collect()
    }
    assert gates["repeated_transaction_id"]["violations"] == 1
    assert gates["repeated_transaction_id"]["sample_key"] == "SAME"
    audit = lineage.id_audit(rows).first()
    assert tuple(audit) == (n, 0, 1)


def test_trace_of_a_hot_id_does_not_multiply(spark, shuffled_joins):
    n = 9_000
    extract = hot_extract(spark, n)
    rows = ledger.build_ledger([extract], trade.mapping(spark))
    totals = ledger.monthly_totals(rows)
    profile = forecast.entity_profile(totals, SCENARIO, LINES)
    lines = report.monthly_lines(
        forecast.calendar_cells(profile, SCENARIO, LINES), SCENARIO, LINES
    )
    traced = lineage.trace([extract], trade.mapping(spark), rows, lines)
    found = traced.groupBy("booked_once", "outcome").count().collect()
    assert {(r[0], r[1]): r[2] for r in found} == {
        (False, "reported"): n // 3,
        (True, "reported"): n - n // 3,
    }


def test_many_entities_equal_separate_runs(spark, sf_dir):
    book = registry.Book(spark, sf_dir)
    together = book.summary.orderBy("entity_id", "reporting_month").collect()
    for entity in ("3", "11"):
        mine = F.col("entity_id") == entity
        totals = ledger.monthly_totals(book.actuals.filter(mine))
        opening = book.opening.filter(mine)
        profile = forecast.entity_profile(totals, SCENARIO, LINES, opening)
        lines = report.monthly_lines(
            forecast.calendar_cells(profile, SCENARIO, LINES), SCENARIO, LINES
        )
        alone = report.monthly_summary(lines, opening, LINES).orderBy("reporting_month").collect()
        assert alone == [r for r in together if r["entity_id"] == entity]


def test_entity_without_activity_still_reports(spark, sf_dir):
    book = registry.Book(spark, sf_dir)
    quiet = spark.createDataFrame([("quiet", 500)], "entity_id string, available_balance_usd bigint")
    profile = forecast.entity_profile(book.totals, SCENARIO, LINES, quiet)
    lines = report.monthly_lines(
        forecast.calendar_cells(profile, SCENARIO, LINES), SCENARIO, LINES
    )
    summary = report.monthly_summary(lines, quiet, LINES).filter("entity_id = 'quiet'").collect()
    assert len(summary) == SCENARIO.total_months
    assert all(r["ending_cash"] == 500 and r["net_change_in_cash"] == 0 for r in summary)
    unopened = report.monthly_summary(lines, quiet, LINES).filter("entity_id = '3'")
    assert unopened.filter("beginning_cash IS NOT NULL").count() == 0


def test_run_rate_divides_by_three_and_last_active_is_the_lines_own(spark):
    import datetime as dt

    def cell(month, line, amount):
        return ("e", dt.date(2000, month, 1), line, amount)

    totals = spark.createDataFrame(
        [
            cell(9, "Parts paid", -100),
            cell(6, "Parts paid", -9000),
            cell(8, "Overhead paid", -2),
            cell(9, "Overhead paid", -3),
            cell(2, "Buildout paid", -70),
            cell(4, "Buildout paid", -40),
            cell(9, "Equipment paid", -1000),
        ],
        "entity_id string, reporting_month date, reporting_line string, signed_amount_usd bigint",
    )
    profile = forecast.entity_profile(totals, SCENARIO, LINES)
    drivers = {
        r["reporting_line"]: r["driver_amount_usd"]
        for r in forecast.line_drivers(profile, LINES).collect()
    }
    assert drivers == {
        "Order cash received": None,
        "Parts paid": -33,
        "Overhead paid": -2,
        "Buildout paid": -40,
        "Equipment paid": None,
        "Credit drawn": None,
    }
