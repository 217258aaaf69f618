"""Binding of the trade tables (orders, lineitem and their dimensions).

Receipts come from filled orders; filled order lines become operating payments,
capital payments or credits, in one scan of ``lineitem``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import MONEY
from tidebook.plans.lines import LAST_MONTH, PLAN_ONLY, RECURRING, Line, LineBook
from tidebook.plans.scenario import Scenario
from tidebook.sources.constants import constant_frame
from tidebook.sources.extract import UNKNOWN_ENTITY, Extract
from tidebook.sources.ids import IdFormat

SCENARIO = Scenario("9+12", fiscal_year=2000, actual_months=9, forecast_months=12)

RECEIPTS = "Receipts"
OPERATING = "Operating payments"
CAPITAL = "Capital payments"
CREDITS = "Credits"
CAPITAL_TYPES = ("LARGE", "PROMO")

LINES = LineBook(
    [
        Line(1, "Operating", "Orders", "Order cash received", "inflow", "FCST-ORD", RECURRING),
        Line(2, "Operating", "Supply", "Parts paid", "outflow", "FCST-PART", RECURRING),
        Line(3, "Operating", "Corporate", "Overhead paid", "outflow", "FCST-OH", RECURRING),
        Line(4, "Investing", "Expansion", "Buildout paid", "outflow", "FCST-BLD", LAST_MONTH),
        Line(5, "Investing", "Supply", "Equipment paid", "outflow", "FCST-EQ", PLAN_ONLY),
        Line(6, "Financing", "Credit", "Credit drawn", "inflow", "FCST-CRD", PLAN_ONLY),
    ]
)

MAPPING_ROWS = [
    (RECEIPTS, "f", "Orders", "Operating", "Order cash received"),
    (OPERATING, "SMALL", "Supply", "Operating", "Parts paid"),
    (OPERATING, "MEDIUM", "Supply", "Operating", "Parts paid"),
    (OPERATING, "ECONOMY", "Corporate", "Operating", "Overhead paid"),
    (OPERATING, "STANDARD", "Corporate", "Operating", "Overhead paid"),
    (CAPITAL, "LARGE", "Expansion", "Investing", "Buildout paid"),
    (CAPITAL, "PROMO", "Supply", "Investing", "Equipment paid"),
    (CREDITS, "r", "Credit", "Financing", "Credit drawn"),
]
MAPPING_SCHEMA = (
    "source string, category string, business_activity string, "
    "cash_flow_section string, reporting_line string"
)

ORDER_IDS = IdFormat("ORD", (("o_orderkey", "bigint"),))
ITEM_IDS = IdFormat(
    "LIN", (("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"))
)

SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def mapping(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, MAPPING_ROWS, MAPPING_SCHEMA)


def dimension_keys(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The keys of each dimension that events are joined with."""
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}
    return {
        name: read(spark, sf_dir, name).select(F.col(key).alias("dimension_key"))
        for name, key in keys.items()
    }


def read_with_file(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows with the name of the file that each came from, as Spark knows it."""
    return read(spark, sf_dir, table).select("*", F.col("_metadata.file_name").alias("file_name"))


def extracts_with_files(spark: SparkSession, sf_dir: str) -> list[Extract]:
    """The extracts with each record's own file instead of the feed's name."""
    facts = {name: read_with_file(spark, sf_dir, name) for name in ("orders", "lineitem")}
    return [replace(e, source_file="file_name") for e in extracts(spark, sf_dir, **facts)]


def extracts(spark: SparkSession, sf_dir: str, **facts: DataFrame) -> list[Extract]:
    """Dimension joins are left joins: an event of an unknown party must not vanish.

    A repeated dimension row multiplies its events, so the id gate sees it; the
    gate on dimension keys names the row. ``facts`` replace ``orders`` or ``lineitem``.

    Unhinted, so dimensions are broadcast only while their known size allows it;
    beyond that they are shuffled and adaptive execution splits hot keys.
    """
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = facts.get("orders", read(spark, sf_dir, "orders")).join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    parts, suppliers = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    items = (
        facts.get("lineitem", read(spark, sf_dir, "lineitem"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    credit = "l_returnflag = 'R'"
    capital = f"p_type IN {CAPITAL_TYPES}"

    def by_source(on_credit: str, on_capital: str, on_operating: str) -> str:
        return (
            f"CASE WHEN {credit} THEN '{on_credit}' "
            f"WHEN {capital} THEN '{on_capital}' ELSE '{on_operating}' END"
        )

    return [
        Extract(
            frame=orders,
            source=f"'{RECEIPTS}'",
            source_system="'Order desk'",
            source_file="'orders.parquet'",
            entity_id="c_nationkey",
            record_id=ORDER_IDS.expression(),
            id_format=ORDER_IDS,
            category="lower(trim(o_orderstatus))",
            vendor="''",
            event_date="o_orderdate",
            direction="'inflow'",
            amount="o_totalprice",
            status="o_orderstatus",
            kept_status="F",
        ),
        Extract(
            frame=items,
            source=by_source(CREDITS, CAPITAL, OPERATING),
            source_system=by_source("Credit desk", "Capital projects", "Accounts payable"),
            source_file="'lineitem.parquet'",
            entity_id="s_nationkey",
            record_id=ITEM_IDS.expression(),
            id_format=ITEM_IDS,
            quantity="l_quantity",
            unit_price="p_retailprice",
            category=f"CASE WHEN {credit} THEN lower(trim(l_returnflag)) ELSE trim(p_type) END",
            vendor="trim(s_name)",
            event_date="l_shipdate",
            direction=f"CASE WHEN {credit} THEN 'inflow' ELSE 'outflow' END",
            amount="l_extendedprice",
            status="l_linestatus",
            kept_status="F",
        ),
    ]


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One opening snapshot per nation: what its customers hold."""
    return (
        read(spark, sf_dir, "customer")
        .groupBy(F.coalesce(F.col("c_nationkey").cast("string"), F.lit(UNKNOWN_ENTITY)).alias("entity_id"))
        .agg(F.sum(F.col("c_acctbal").cast(MONEY)).alias("available_balance"))
        .select(
            "entity_id",
            F.concat(F.lit("ACCT-"), "entity_id").alias("account_id"),
            F.lit(dt.date(SCENARIO.fiscal_year - 1, 12, 31)).alias("balance_date"),
            F.lit("USD").alias("currency"),
            "available_balance",
        )
    )


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned amounts per nation: equipment, a credit, and one recurring line replaced."""
    nation = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("entity_id"),
        ((F.col("n_nationkey") + 1) * 1000).cast("bigint").alias("unit"),
    )
    planned = F.array(
        *[
            F.struct(
                F.lit(month).alias("reporting_month"),
                F.lit(line).alias("reporting_line"),
                (F.col("unit") * factor).alias("amount_usd"),
            )
            for month, line, factor in PLANNED
        ]
    )
    return nation.select("entity_id", F.inline(planned))


PLANNED = [
    (dt.date(2000, 11, 1), "Equipment paid", -5),
    (dt.date(2001, 2, 1), "Credit drawn", 20),
    (dt.date(2001, 2, 1), "Overhead paid", -1),
    (dt.date(2003, 1, 1), "Credit drawn", 7),
    (dt.date(2000, 12, 1), "Unlisted line", 3),
]


def example_ids(ledger: DataFrame) -> DataFrame:
    """Ids to follow: the largest transaction of every entity and line."""
    rank = F.struct((-F.abs("signed_amount")).alias("size"), F.col("transaction_id"))
    return (
        ledger.groupBy("entity_id", "reporting_line")
        .agg(F.min(rank).alias("top"))
        .select("entity_id", "reporting_line", F.col("top.transaction_id").alias("transaction_id"))
    )
