"""From a source record through its rule to the ledger and the report, and back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.operators.ledger import build_ledger, classify
from tidebook.plans.scenario import Scenario, shift_month
from tidebook.sources.extract import Extract, all_records
from tidebook.sources.ids import literal_ids

CLASSIFICATION = ("source_category", "business_activity", "cash_flow_section", "reporting_line")


def _only(frame: DataFrame, ids: DataFrame | None) -> DataFrame:
    if ids is None:
        return frame
    # Distinct first: copies of an asked-for id collapse before the shuffle.
    return frame.join(ids.select("transaction_id").distinct(), "transaction_id", "left_semi")


def booked_once(ledger: DataFrame, report_lines: DataFrame) -> DataFrame:
    """One row per ledger id: how often it occurs, its first occurrence, its report line.

    Copies of an id meet in the partial aggregation, so a source record never
    joins with more than one row.
    """
    cell = ["entity_id", "reporting_month", "reporting_line"]
    reported = report_lines.select(*cell, F.col("signed_amount_usd").alias("line_amount_usd"))
    first = ("reporting_month", *CLASSIFICATION, "signed_amount_usd", "line_amount_usd")
    return (
        ledger.select("entity_id", "transaction_id", *first[:-1])
        .join(reported, cell, "left")
        .groupBy("transaction_id")
        .agg(F.count("*").alias("ledger_rows"), F.min(F.struct(*first)).alias("booked"))
    )


def trace(
    extracts: Sequence[Extract],
    mapping: DataFrame,
    ledger: DataFrame,
    report_lines: DataFrame,
    ids: DataFrame | None = None,
    with_file: bool = False,
) -> DataFrame:
    """Every source record (or those of ``ids``) with its rule, ledger row and line.

    Records that never reached the ledger are kept, with ``outcome`` saying why.
    ``with_file`` adds the file that the record came from.
    """
    records = classify(_only(all_records(extracts), ids), mapping)
    booked = booked_once(_only(ledger, ids), report_lines)
    in_ledger = F.col("booked").isNotNull()
    same_class = F.lit(True)
    for c in CLASSIFICATION:
        same_class = same_class & F.col(c).eqNullSafe(F.col(f"booked.{c}"))
    return records.join(booked, "transaction_id", "left").select(
        "entity_id",
        "transaction_id",
        "source",
        *(["source_file"] if with_file else []),
        "status",
        "vendor",
        "cash_date",
        "source_category",
        "amount",
        F.col("cash_flow_section").alias("rule_section"),
        F.col("business_activity").alias("rule_activity"),
        F.col("reporting_line").alias("rule_line"),
        F.coalesce("ledger_rows", F.lit(0)).alias("ledger_rows"),
        "booked.reporting_month",
        "booked.reporting_line",
        "booked.signed_amount_usd",
        "booked.line_amount_usd",
        F.coalesce(F.col("ledger_rows") == 1, F.lit(False)).alias("booked_once"),
        (in_ledger & F.col("reporting_line").isNotNull() & same_class).alias("rule_agrees"),
        F.when(~F.col("kept"), "status not kept")
        .when(F.col("reporting_line").isNull(), "unmapped")
        .when(~in_ledger, "not in ledger")
        .when(F.col("booked.line_amount_usd").isNull(), "not reported")
        .otherwise("reported")
        .alias("outcome"),
    )


def records_of_ids(
    extracts: Sequence[Extract], mapping: DataFrame, scenario: Scenario, ids: DataFrame
) -> tuple[list[Extract], DataFrame]:
    """Extracts and closed ledger cut down to the ids asked for.

    Up to ``LITERAL_IDS`` ids become predicates on the key columns, which the file
    scan prunes by; more are left to the joins.
    """
    asked = literal_ids(ids)
    chosen = list(extracts) if asked is None else [e.for_ids(asked) for e in extracts]
    return chosen, build_ledger(chosen, mapping, closed_only=scenario)


def trace_selected(
    extracts: Sequence[Extract], mapping: DataFrame, scenario: Scenario, report_lines: DataFrame, ids: DataFrame
) -> DataFrame:
    """As ``trace`` for some ids, reading of the feeds what can hold them."""
    chosen, ledger = records_of_ids(extracts, mapping, scenario, ids)
    return trace(chosen, mapping, ledger, report_lines, ids)


def id_audit(ledger: DataFrame) -> DataFrame:
    """Rows, blank ids and repeated ids of a ledger, one row."""
    per_id = ledger.groupBy(F.trim(F.coalesce("transaction_id", F.lit(""))).alias("id")).agg(
        F.count("*").alias("n")
    )
    named = F.col("id") != ""
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("blank_ids"),
        F.count(F.when(named & (F.col("n") > 1), 1)).alias("repeated_ids"),
    )


def id_presence(ids: DataFrame, extracts: Sequence[Extract], ledger: DataFrame) -> DataFrame:
    """How often each asked-for id occurs in the sources and in the ledger."""

    def counted(frame, name):
        return _only(frame, ids).groupBy("transaction_id").agg(F.count("*").alias(name))

    asked = ids.select("transaction_id").distinct()
    return (
        asked.join(counted(all_records(extracts), "source_rows"), "transaction_id", "left")
        .join(counted(ledger, "ledger_rows"), "transaction_id", "left")
        .na.fill(0, ["source_rows", "ledger_rows"])
        .withColumn("found_once", (F.col("source_rows") == 1) & (F.col("ledger_rows") == 1))
    )


def trace_line_sums(ledger: DataFrame, report_lines: DataFrame, ids: DataFrame) -> DataFrame:
    """For each asked-for transaction: does its reporting line equal the sum behind it?"""
    keys = ["entity_id", "reporting_month", "reporting_line"]
    behind = ledger.groupBy(*keys).agg(
        F.count("*").alias("n_transactions"), F.sum("signed_amount_usd").alias("transaction_sum")
    )
    reported = report_lines.select(*keys, F.col("signed_amount_usd").alias("reported_amount"))
    return (
        _only(ledger, ids)
        .select("transaction_id", *keys)
        .join(behind, keys, "left")
        .join(reported, keys, "left")
        .withColumn(
            "agrees",
            F.coalesce(F.col("transaction_sum") == F.col("reported_amount"), F.lit(False)),
        )
    )


def drilldown(ledger: DataFrame, reporting_month: dt.date, reporting_line: str) -> DataFrame:
    """Transactions behind one report cell, of every entity.

    The month is asked for as a date range too, which the scan can use.
    """
    day = F.col("cash_date")
    return ledger.filter(
        (F.col("reporting_month") == F.lit(reporting_month))
        & (day >= F.lit(reporting_month))
        & (day < F.lit(shift_month(reporting_month, 1)))
        & (F.col("reporting_line") == reporting_line)
    )
