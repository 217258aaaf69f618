"""The sample cash-flow folder, and the figures it leads to."""

from __future__ import annotations

import calendar
import csv
from pathlib import Path

# Nine closed months of the sample, per month.
COINS_SOLD = [3, 3, 4, 3, 4, 5, 4, 4, 5]
POWER_MWH = [2600, 2700, 2700] * 3
OVERHEAD = [60000, 70000, 70000] * 3
BUILDOUT = [100000, 150000, 250000, 250000, 350000, 400000, 400000, 500000, 600000]
EQUIPMENT = {2: 500000}
DRAWS = {1: 500000, 4: 500000, 7: 1000000}
COIN_PRICE, POWER_RATE, OPENING = 100000, 100, 2000000

# What the drivers give for every open month.
PROJECTED = {
    "Mining cash received": 433333,
    "Mining power paid": -266667,
    "Overhead paid": -66667,
    "Data center buildout paid": -600000,
    "Mining equipment paid": 0,
    "Construction loan drawn": 0,
}
ENDING_CASH = [2380000, 1690000, 1500000, 1730000, 1440000, 1200000, 1880000, 1440000, 1000000] + [
    499999, -2, -500003, -1000004, -1500005, -2000006,
    -2500007, -3000008, -3500009, -4000010, -4500011, -5000012,
]
# The mapping, and the columns of each file.
MAPPING = [
    ("Bitcoin sales", "settled", "Bitcoin mining operations", "Operating", "Mining cash received"),
    ("Operating payments", "Mining power", "Bitcoin mining operations", "Operating", "Mining power paid"),
    ("Operating payments", "Overhead", "Corporate operations", "Operating", "Overhead paid"),
    ("Capital payments", "Data center buildout", "Data center expansion", "Investing", "Data center buildout paid"),
    ("Capital payments", "Mining equipment", "Bitcoin mining operations", "Investing", "Mining equipment paid"),
    ("Loan draws", "funded", "Data center financing", "Financing", "Construction loan drawn"),
]

HEADERS = {
    "raw/bitcoin_sales.csv": "sale_id,settlement_date,asset,btc_sold,usd_per_btc,usd_received,status",
    "raw/operating_payments.csv": "invoice_id,payment_date,vendor,cost_category,mwh,rate_per_mwh,amount_paid,status",
    "raw/capital_payments.csv": "payment_id,payment_date,project_id,vendor,spend_category,amount_paid,status",
    "raw/loan_draws.csv": "draw_id,funding_date,facility_id,lender,draw_amount,status",
    "raw/bank_balance.csv": "account_id,balance_date,currency,available_balance",
    "transformed/activity_mapping.csv": "source,category,business_activity,cash_flow_section,reporting_line",
    "reporting/forecast_scenario.csv": "scenario,fiscal_year,actual_months,forecast_months",
    "reporting/plan_schedule.csv": "reporting_month,reporting_line,amount_usd",
    "reporting/agreed_figures.csv": "figure,cash_flow_section,cash_direction,amount_usd",
}

# The figures agreed for the sample.
AGREED = [
    ("control_total", "Operating", "inflow", 3500000),
    ("control_total", "Operating", "outflow", -3000000),
    ("control_total", "Investing", "outflow", -3500000),
    ("control_total", "Financing", "inflow", 2000000),
    ("control_total", "All", "net", -1000000),
    ("opening_amount", "", "", 2000000),
    ("total_net_change", "", "", -7000012),
    ("final_balance", "", "", -5000012),
]


def tables() -> dict[str, list[list]]:
    """Rows per file."""
    found = {name: [] for name in HEADERS}
    for month in range(1, 10):
        label = f"2026-{month:02d}"
        last = f"{label}-{calendar.monthrange(2026, month)[1]:02d}"
        coins, mwh = COINS_SOLD[month - 1], POWER_MWH[month - 1]
        found["raw/bitcoin_sales.csv"].append(
            [f"SALE-{label}", last, "BTC", coins, COIN_PRICE, coins * COIN_PRICE, "SETTLED"]
        )
        found["raw/operating_payments.csv"] += [
            [f"INV-PWR-{label}", f"{label}-15", "Vendor of power", "Mining power", mwh, POWER_RATE, mwh * POWER_RATE, "PAID"],
            [f"INV-OH-{label}", f"{label}-20", "Vendor of offices", "Overhead", "", "", OVERHEAD[month - 1], "PAID"],
        ]
        found["raw/capital_payments.csv"].append(
            [f"PAY-DC-{label}", last, "PRJ-1", "Vendor of buildings", "Data center buildout", BUILDOUT[month - 1], "PAID"]
        )
    for month, amount in EQUIPMENT.items():
        label = f"2026-{month:02d}"
        found["raw/capital_payments.csv"].append(
            [f"PAY-MIN-EQ-{label}", f"{label}-12", "PRJ-2", "Vendor of machines", "Mining equipment", amount, "PAID"]
        )
    for month, amount in DRAWS.items():
        label = f"2026-{month:02d}"
        found["raw/loan_draws.csv"].append(
            [f"DRAW-CL-{label}", f"{label}-08", "LOAN-1", "Lender one", amount, "FUNDED"]
        )
    found["raw/bank_balance.csv"].append(["ACCT-USD-100100", "2026-12-31", "USD", OPENING])
    found["transformed/activity_mapping.csv"] += [list(row) for row in MAPPING]
    found["reporting/forecast_scenario.csv"].append(["9+12", 2026, 9, 12])
    found["reporting/agreed_figures.csv"] += [list(row) for row in AGREED]
    return found


def write(folder: Path, rows: dict[str, list[list]] | None = None) -> str:
    for name, body in (rows or tables()).items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with path.open("w", newline="") as file:
            file.write(HEADERS[name] + "\n")
            csv.writer(file, lineterminator="\n").writerows(body)
    return str(folder)


def inputs(spark, folder: str, **changes):
    from tidebook.plans.staged_run import Inputs
    from tidebook.sources import cashbook

    files = cashbook.CashbookFiles(spark, folder)
    given = dict(
        extracts=files.extracts(),
        mapping=files.mapping(),
        bank=files.bank(),
        scenario=files.scenario(),
        lines=cashbook.LINES,
        vendor_sources=cashbook.VENDOR_SOURCES,
        plan=files.plan(),
        expectations=files.expectations(),
        single_entity=True,
    )
    return Inputs(**(given | changes))
