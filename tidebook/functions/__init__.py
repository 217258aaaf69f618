"""Column expressions shared by the operators."""

from tidebook.functions.money import MONEY, cents, money, signed, whole_dollars
from tidebook.functions.months import month_label, month_start
from tidebook.functions.text import blank, cleaned, status_code, text_literal

__all__ = [
    "MONEY",
    "blank",
    "cents",
    "cleaned",
    "money",
    "month_label",
    "month_start",
    "signed",
    "status_code",
    "text_literal",
    "whole_dollars",
]
