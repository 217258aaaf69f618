"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(text: Column) -> Column:
    return F.trim(text)


def status_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def blank(text: Column) -> Column:
    """True for NULL, empty and all-space text; never NULL."""
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def text_literal(text: str) -> str:
    """``text`` quoted for a SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
