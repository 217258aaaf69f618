"""Binding of the cash-flow CSV extracts: five raw files, mapping, scenario, plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import cleaned, text_literal
from tidebook.plans.lines import LAST_MONTH, PLAN_ONLY, RECURRING, Line, LineBook
from tidebook.plans.scenario import Scenario
from tidebook.plans.staged_run import Expectations
from tidebook.sources import schemas
from tidebook.sources.extract import Extract
from tidebook.sources.files import exists, read_csv
from tidebook.sources.quarantine import Split, all_rejects, read_text_csv, split_readable

ENTITY = "company"
AGREED_FILE = "reporting/agreed_figures.csv"

# Labels, file names and lines that the published rows carry.
MINING = "Bitcoin mining operations"
LINES = LineBook(
    [
        Line(1, "Operating", MINING, "Mining cash received", "inflow", "FCST-SALE", RECURRING),
        Line(2, "Operating", MINING, "Mining power paid", "outflow", "FCST-PWR", RECURRING),
        Line(3, "Operating", "Corporate operations", "Overhead paid", "outflow", "FCST-OH", RECURRING),
        Line(4, "Investing", "Data center expansion", "Data center buildout paid", "outflow", "FCST-DC", LAST_MONTH),
        Line(5, "Investing", MINING, "Mining equipment paid", "outflow", "FCST-EQ", PLAN_ONLY),
        Line(6, "Financing", "Data center financing", "Construction loan drawn", "inflow", "FCST-DRAW", PLAN_ONLY),
    ]
)
SALES = "Bitcoin sales"
OPERATING = "Operating payments"
CAPITAL = "Capital payments"
DRAWS = "Loan draws"
FILE_NAME = "file_name"
FEEDS = (
    ("bitcoin_sales.csv", schemas.SALES, "sale_id"),
    ("operating_payments.csv", schemas.OPERATING_PAYMENTS, "invoice_id"),
    ("capital_payments.csv", schemas.CAPITAL_PAYMENTS, "payment_id"),
    ("loan_draws.csv", schemas.LOAN_DRAWS, "draw_id"),
)
VENDOR_SOURCES = (OPERATING, CAPITAL, DRAWS)


class CashbookFiles:
    """The folder layout: ``raw/``, ``transformed/`` and ``reporting/``.

    An extract may be one file or a folder of them. ``quarantine`` sets unreadable
    records apart instead of failing the read; ``with_files`` has each record name the
    file that it came from instead of its extract.
    """

    def __init__(self, spark: SparkSession, folder: str, quarantine: bool = False, with_files: bool = False):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.quarantine, self.with_files = quarantine, with_files

    def _read(self, path: str, schema: str) -> DataFrame:
        return read_csv(self.spark, f"{self.folder}/{path}", schema)

    def scenario_table(self) -> DataFrame:
        return self._read("reporting/forecast_scenario.csv", schemas.SCENARIO)

    def scenario(self) -> Scenario:
        return Scenario.from_frame(self.scenario_table())

    def mapping(self) -> DataFrame:
        return self._read("transformed/activity_mapping.csv", schemas.ACTIVITY_MAPPING)

    def plan(self) -> DataFrame:
        plan = self._read("reporting/plan_schedule.csv", schemas.PLAN_SCHEDULE)
        return plan.select(F.lit(ENTITY).alias("entity_id"), "*")

    def bank(self) -> DataFrame:
        bank = self._read("raw/bank_balance.csv", schemas.BANK_BALANCE)
        return bank.select(F.lit(ENTITY).alias("entity_id"), "*")

    def extracts(self) -> list[Extract]:
        return [
            self._extract(
                "bitcoin_sales.csv",
                schemas.SALES,
                source=SALES,
                system="Treasury / exchange",
                record_id="sale_id",
                category="lower(trim(status))",
                vendor="''",
                event_date="settlement_date",
                direction="inflow",
                amount="usd_received",
                kept="SETTLED",
                quantity="btc_sold",
                unit_price="usd_per_btc",
            ),
            self._extract(
                "operating_payments.csv",
                schemas.OPERATING_PAYMENTS,
                source=OPERATING,
                system="Accounts payable",
                record_id="invoice_id",
                category="trim(cost_category)",
                vendor="trim(vendor)",
                event_date="payment_date",
                direction="outflow",
                amount="amount_paid",
                kept="PAID",
                quantity="mwh",
                unit_price="rate_per_mwh",
            ),
            self._extract(
                "capital_payments.csv",
                schemas.CAPITAL_PAYMENTS,
                source=CAPITAL,
                system="Capital projects / AP",
                record_id="payment_id",
                category="trim(spend_category)",
                vendor="trim(vendor)",
                event_date="payment_date",
                direction="outflow",
                amount="amount_paid",
                kept="PAID",
            ),
            self._extract(
                "loan_draws.csv",
                schemas.LOAN_DRAWS,
                source=DRAWS,
                system="Treasury / loan system",
                record_id="draw_id",
                category="lower(trim(status))",
                vendor="trim(lender)",
                event_date="funding_date",
                direction="inflow",
                amount="draw_amount",
                kept="FUNDED",
            ),
        ]

    def expectations(self) -> Expectations:
        """Agreed figures, if the folder has any. A file without a figure fails that figure's gate."""
        path = f"{self.folder}/{AGREED_FILE}"
        if not exists(self.spark, path):
            return Expectations()
        agreed = self._read(AGREED_FILE, schemas.AGREED_FIGURES)

        def of_entity(figure: str) -> DataFrame:
            rows = agreed.filter(cleaned(F.col("figure")) == figure)
            return rows.select(F.lit(ENTITY).alias("entity_id"), F.col("amount_usd").alias("expected_amount"))

        controls = agreed.filter(cleaned(F.col("figure")) == "control_total")
        return Expectations(
            control_totals=controls.select(
                cleaned(F.col("cash_flow_section")).alias("cash_flow_section"),
                cleaned(F.col("cash_direction")).alias("cash_direction"),
                F.col("amount_usd").alias("expected_amount"),
            ),
            opening=of_entity("opening_amount"),
            net_change=of_entity("total_net_change"),
            final_balance=of_entity("final_balance"),
        )

    def rejects(self) -> DataFrame | None:
        """Values of all extracts that could not be read, where quarantine is on."""
        if not self.quarantine:
            return None
        return all_rejects(*[self._split(*feed) for feed in FEEDS])

    def _split(self, file: str, schema: str, record_id: str) -> Split:
        raw = read_text_csv(self.spark, f"{self.folder}/raw/{file}", schema)
        raw = raw.select("*", F.col("_metadata.file_name").alias(FILE_NAME))
        return split_readable(raw, schema, file, f"trim({record_id})")

    def _records(self, file: str, schema: str, record_id: str) -> DataFrame:
        if self.quarantine:
            return self._split(file, schema, record_id).valid
        return self._read(f"raw/{file}", schema).select("*", F.col("_metadata.file_name").alias(FILE_NAME))

    def _extract(
        self,
        file,
        schema,
        *,
        source,
        system,
        record_id,
        category,
        vendor,
        event_date,
        direction,
        amount,
        kept,
        quantity=None,
        unit_price=None,
    ) -> Extract:
        return Extract(
            frame=self._records(file, schema, record_id),
            source=text_literal(source),
            source_system=text_literal(system),
            source_file=FILE_NAME if self.with_files else text_literal(file),
            entity_id=text_literal(ENTITY),
            record_id=f"trim({record_id})",
            category=category,
            vendor=vendor,
            event_date=event_date,
            direction=text_literal(direction),
            amount=amount,
            status="status",
            kept_status=kept,
            quantity=quantity,
            unit_price=unit_price,
        )
