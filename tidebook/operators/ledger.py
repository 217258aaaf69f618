"""Raw extracts to one classified, signed ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import cleaned, month_start, signed, whole_dollars
from tidebook.plans.scenario import Scenario
from tidebook.sources.extract import Extract, all_records, kept_records

TRANSACTION_COLUMNS = (
    "transaction_id",
    "source_system",
    "source_file",
    "source_category",
    "vendor",
    "cash_date",
    "reporting_month",
    "business_activity",
    "cash_flow_section",
    "reporting_line",
    "cash_direction",
    "signed_amount_usd",
)
RULE_COLUMNS = ("source", "category", "business_activity", "cash_flow_section", "reporting_line")
TOTAL_KEYS = (
    "entity_id",
    "reporting_month",
    "cash_flow_section",
    "business_activity",
    "reporting_line",
)


class ClosedWindowError(ValueError):
    """An event lies outside the closed window of a strict close."""


def mapping_rules(mapping: DataFrame) -> DataFrame:
    return mapping.select(*[cleaned(F.col(c)).alias(c) for c in RULE_COLUMNS])


def status_counts(extracts: Sequence[Extract]) -> DataFrame:
    """Records by source and status, kept or dropped."""
    return (
        all_records(extracts)
        .groupBy("source", "status", "kept")
        .agg(F.count("*").alias("n_records"), F.sum("amount").alias("amount"))
    )


def classify(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach the mapping rule; a category without a rule keeps NULL for the gate.

    No broadcast hint: the optimizer broadcasts the mapping while its size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
    adaptive execution splits a hot category.
    """
    rules = mapping_rules(mapping).withColumnRenamed("category", "source_category")
    return records.join(rules, ["source", "source_category"], "left")


def build_ledger(
    extracts: Sequence[Extract], mapping: DataFrame, closed_only: Scenario | None = None
) -> DataFrame:
    """Kept records of all extracts, classified and signed.

    ``amount`` columns keep the cents; ``signed_amount_usd`` is rounded per row,
    and is what forecasts and reports add up. With ``closed_only`` the closed
    window reaches the scans; the result equals filtering the full ledger.
    """
    amount = signed(F.col("amount"), F.col("cash_direction"))
    return classify(kept_records(extracts, closed_only), mapping).select(
        "entity_id",
        "transaction_id",
        "source_system",
        "source_file",
        "source",
        "source_category",
        "vendor",
        "cash_date",
        month_start(F.col("cash_date")).alias("reporting_month"),
        "business_activity",
        "cash_flow_section",
        "reporting_line",
        "cash_direction",
        amount.alias("signed_amount"),
        whole_dollars(amount).alias("signed_amount_usd"),
    )


def close_actuals(
    ledger: DataFrame, scenario: Scenario, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split into events of the closed window and rejects.

    ``strict`` runs a job and raises on the first reject found.
    """
    inside = F.coalesce(scenario.closed(F.col("cash_date")), F.lit(False))
    rejects = ledger.filter(~inside)
    if strict and rejects.take(1):
        raise ClosedWindowError("a source event falls outside the closed months")
    return ledger.filter(scenario.closed(F.col("cash_date"))), rejects


def transactions(ledger: DataFrame) -> DataFrame:
    """The published transaction columns, without the working ones."""
    return ledger.select("entity_id", *TRANSACTION_COLUMNS)


def all_transactions(actuals: DataFrame, forecast: DataFrame, scenario: Scenario) -> DataFrame:
    """Actual and projected transactions together, told apart by their month."""
    both = transactions(actuals).unionByName(transactions(forecast))
    return both.withColumn("amount_type", scenario.amount_type(F.col("reporting_month")))


def opening_balance(bank: DataFrame) -> DataFrame:
    """Account snapshots as opening cash. Keyed by entity, never joined on date."""
    return bank.select(
        F.col("entity_id").cast("string").alias("entity_id"),
        cleaned(F.col("account_id")).alias("account_id"),
        F.col("balance_date").cast("date").alias("balance_date"),
        cleaned(F.col("currency")).alias("currency"),
        whole_dollars(F.col("available_balance")).alias("available_balance_usd"),
    )


def monthly_totals(ledger: DataFrame) -> DataFrame:
    """Whole-dollar totals per entity, month, section, activity and line.

    The only aggregation that sees ledger rows; drivers, reports and
    reconciliation work on its few rows. A hot entity or line collapses in the
    partial aggregation before the shuffle.
    """
    return ledger.groupBy(*TOTAL_KEYS).agg(F.sum("signed_amount_usd").alias("signed_amount_usd"))


def closed_sums(ledger: DataFrame) -> DataFrame:
    """Totals by the keys of ``monthly_totals`` and direction, in dollars and in cents.

    A run that needs several kinds of totals adds them up from these rows, so that
    the ledger is read once for all of them.
    """
    return ledger.groupBy(*TOTAL_KEYS, "cash_direction").agg(
        F.sum("signed_amount_usd").alias("signed_amount_usd"), F.sum("signed_amount").alias("signed_amount")
    )
