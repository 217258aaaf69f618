"""Month expressions. ``trunc`` stays a DATE where ``date_trunc`` would not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
