"""Reporting lines: one dimension for mapping, forecasting and reporting."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.sources.constants import constant_frame

RECURRING = "recurring"
LAST_MONTH = "last_month"
PLAN_ONLY = "plan_only"
SECTIONS = ("Operating", "Investing", "Financing")
SECTION_RANK_OTHER = 99


@dataclass(frozen=True)
class Line:
    display_order: int
    cash_flow_section: str
    business_activity: str
    reporting_line: str
    cash_direction: str
    id_prefix: str
    driver_kind: str

    @property
    def column(self) -> str:
        """Name of this line's column in the monthly summary."""
        return re.sub(r"\W+", "_", self.reporting_line.lower()).strip("_")


class LineBook:
    """The ordered lines of one report. A Python constant, so its size is known."""

    SCHEMA = (
        "display_order int, cash_flow_section string, business_activity string, "
        "reporting_line string, cash_direction string, id_prefix string, driver_kind string"
    )

    def __init__(self, lines: Sequence[Line]):
        self._lines = tuple(sorted(lines, key=lambda line: line.display_order))
        for field in ("display_order", "reporting_line", "id_prefix", "column"):
            values = [getattr(line, field) for line in self._lines]
            if len(set(values)) != len(values):
                raise ValueError(f"{field} repeats in the line book")
        for line in self._lines:
            if line.cash_flow_section not in SECTIONS:
                raise ValueError(f"unknown section {line.cash_flow_section!r}")
            if line.driver_kind not in (RECURRING, LAST_MONTH, PLAN_ONLY):
                raise ValueError(f"unknown driver kind {line.driver_kind!r}")

    def __iter__(self) -> Iterator[Line]:
        return iter(self._lines)

    def __len__(self) -> int:
        return len(self._lines)

    def names(self, kind: str | None = None) -> list[str]:
        return [x.reporting_line for x in self._lines if kind in (None, x.driver_kind)]

    def in_section(self, section: str) -> list[Line]:
        return [x for x in self._lines if x.cash_flow_section == section]

    def without(self, reporting_line: str) -> LineBook:
        return LineBook([x for x in self._lines if x.reporting_line != reporting_line])

    def knows(self, reporting_line: Column) -> Column:
        """True, false, and false for NULL too."""
        return F.coalesce(reporting_line.isin(self.names()), F.lit(False))

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                x.display_order,
                x.cash_flow_section,
                x.business_activity,
                x.reporting_line,
                x.cash_direction,
                x.id_prefix,
                x.driver_kind,
            )
            for x in self._lines
        ]
        return constant_frame(spark, rows, self.SCHEMA)


def section_rank(section: Column) -> Column:
    rank = F.lit(SECTION_RANK_OTHER)
    for position, name in reversed(list(enumerate(SECTIONS, start=1))):
        rank = F.when(section == name, position).otherwise(rank)
    return rank
