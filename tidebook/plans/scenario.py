"""The scenario row: how many months are closed, how many are projected.

It is read once and becomes date literals, so closed-window filters reach the
scans as plain range predicates and no plan carries a one-row cross join.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAILING_MONTHS = 3


class ScenarioError(ValueError):
    """The scenario table does not describe one usable scenario."""


def shift_month(month: dt.date, n: int) -> dt.date:
    years, index = divmod(month.year * 12 + month.month - 1 + n, 12)
    return dt.date(years, index + 1, 1)


@dataclass(frozen=True)
class Scenario:
    name: str
    fiscal_year: int
    actual_months: int
    forecast_months: int

    def __post_init__(self) -> None:
        if not 1 <= self.actual_months <= 12:
            raise ScenarioError(f"actual_months must lie in 1..12, got {self.actual_months}")
        if self.forecast_months < 1:
            raise ScenarioError(f"forecast_months must be positive, got {self.forecast_months}")
        wanted = f"{self.actual_months}+{self.forecast_months}"
        if self.name != wanted:
            raise ScenarioError(f"scenario {self.name!r} does not match its months, {wanted!r}")

    @classmethod
    def from_frame(cls, table: DataFrame) -> Scenario:
        rows = table.select(
            F.trim("scenario").alias("name"), "fiscal_year", "actual_months", "forecast_months"
        ).take(2)
        if len(rows) != 1:
            raise ScenarioError("the scenario table must hold exactly one row")
        if any(value is None for value in rows[0]):
            raise ScenarioError("the scenario row has an empty field")
        return cls(**rows[0].asDict())

    @property
    def first_month(self) -> dt.date:
        return dt.date(self.fiscal_year, 1, 1)

    @property
    def last_closed_month(self) -> dt.date:
        return shift_month(self.first_month, self.actual_months - 1)

    @property
    def first_open_month(self) -> dt.date:
        return shift_month(self.first_month, self.actual_months)

    @property
    def last_month(self) -> dt.date:
        return shift_month(self.last_closed_month, self.forecast_months)

    @property
    def first_trailing_month(self) -> dt.date:
        return shift_month(self.last_closed_month, 1 - TRAILING_MONTHS)

    @property
    def total_months(self) -> int:
        return self.actual_months + self.forecast_months

    def closed(self, day: Column) -> Column:
        """Range predicate of the closed window; prunes partitions and row groups."""
        return (day >= F.lit(self.first_month)) & (day < F.lit(self.first_open_month))

    def trailing(self, month: Column) -> Column:
        return month.between(F.lit(self.first_trailing_month), F.lit(self.last_closed_month))

    def in_horizon(self, month: Column) -> Column:
        return month.between(F.lit(self.first_month), F.lit(self.last_month))

    def is_open(self, month: Column) -> Column:
        return month > F.lit(self.last_closed_month)

    def amount_type(self, month: Column) -> Column:
        return F.when(self.is_open(month), "Forecast").otherwise("Actual")

    def months(self, which: str = "all") -> Column:
        """Array of month starts: ``actual``, ``forecast`` or ``all``."""
        first, last = {
            "actual": (self.first_month, self.last_closed_month),
            "forecast": (self.first_open_month, self.last_month),
            "all": (self.first_month, self.last_month),
        }[which]
        return F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
