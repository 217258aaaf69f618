"""Published figures against the ledger, at three levels.

Both sides are aggregates, tagged and summed together. That gives the rows a
full outer join would give, so a ledger group that no report row covers shows
up too, for one shuffle and no sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.operators.report import net_column
from tidebook.plans.lines import SECTIONS

NET_CHANGE = "Net change"


def side_by_side(
    report: DataFrame, ledger: DataFrame, keys: tuple[str, ...], amount: str = "signed_amount_usd"
) -> DataFrame:
    """Both totals per key. ``agrees`` needs a report row, whatever the ledger holds."""
    none = F.lit(None).cast("bigint")
    tagged = report.select(
        *keys, F.col(amount).alias("report_usd"), none.alias("ledger_usd")
    ).unionByName(ledger.select(*keys, none.alias("report_usd"), F.col(amount).alias("ledger_usd")))
    ledger_or_zero = F.coalesce("ledger_usd", F.lit(0))
    return (
        tagged.groupBy(*keys)
        .agg(F.sum("report_usd").alias("report_usd"), F.sum("ledger_usd").alias("ledger_usd"))
        .withColumn("difference_usd", F.coalesce("report_usd", F.lit(0)) - ledger_or_zero)
        .withColumn("agrees", F.coalesce(F.col("report_usd") == ledger_or_zero, F.lit(False)))
    )


def reconcile_lines(report_lines: DataFrame, totals: DataFrame) -> DataFrame:
    return side_by_side(report_lines, totals, ("entity_id", "reporting_month", "reporting_line"))


def reconcile_activities(report_lines: DataFrame, totals: DataFrame) -> DataFrame:
    keys = ("entity_id", "reporting_month", "cash_flow_section", "business_activity")
    return side_by_side(report_lines, totals, keys)


def reconcile_sections(summary: DataFrame, totals: DataFrame) -> DataFrame:
    """Section nets and the net change of every month."""
    measures = [(section, net_column(section)) for section in SECTIONS]
    measures.append((NET_CHANGE, "net_change_in_cash"))
    reported = summary.select(
        "entity_id",
        "reporting_month",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), F.col(c).alias("signed_amount_usd"))
                    for name, c in measures
                ]
            )
        ),
    )
    booked = totals.select(
        "entity_id",
        "reporting_month",
        F.explode(F.array("cash_flow_section", F.lit(NET_CHANGE))).alias("measure"),
        "signed_amount_usd",
    )
    return side_by_side(reported, booked, ("entity_id", "reporting_month", "measure"))
