"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

SALES = (
    "sale_id string, settlement_date date, asset string, btc_sold decimal(18,8), "
    "usd_per_btc decimal(18,2), usd_received decimal(18,2), status string"
)
OPERATING_PAYMENTS = (
    "invoice_id string, payment_date date, vendor string, cost_category string, "
    "mwh decimal(18,4), rate_per_mwh decimal(18,4), amount_paid decimal(18,2), status string"
)
CAPITAL_PAYMENTS = (
    "payment_id string, payment_date date, project_id string, vendor string, "
    "spend_category string, amount_paid decimal(18,2), status string"
)
LOAN_DRAWS = (
    "draw_id string, funding_date date, facility_id string, lender string, "
    "draw_amount decimal(18,2), status string"
)
BANK_BALANCE = (
    "account_id string, balance_date date, currency string, available_balance decimal(18,2)"
)
ACTIVITY_MAPPING = (
    "source string, category string, business_activity string, cash_flow_section string, "
    "reporting_line string"
)
SCENARIO = "scenario string, fiscal_year int, actual_months int, forecast_months int"
# Figures: control_total (by section and direction, All and net for the whole),
# opening_amount, total_net_change, final_balance.
AGREED_FIGURES = (
    "figure string, cash_flow_section string, cash_direction string, amount_usd decimal(18,2)"
)
PLAN_SCHEDULE = "reporting_month date, reporting_line string, amount_usd bigint"
