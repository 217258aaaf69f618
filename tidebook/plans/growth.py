"""Compound growth of run rates, in exact decimals."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal, localcontext

PLACES = 12
FACTOR = "decimal(17,12)"
LARGEST = Decimal(10) ** 5


@dataclass(frozen=True)
class Growth:
    """Monthly growth by reporting line.

    The first open month has grown once. A month's factor is that of the month
    before times 1 + rate, rounded to ``PLACES`` decimal places, halves up; amounts are
    rounded once, to whole dollars, halves to even.
    """

    rates: Mapping[str, Decimal]

    def factors(self, reporting_line: str, months: int) -> list[Decimal]:
        rate = self.rates.get(reporting_line, Decimal(0))
        if rate <= -1:
            raise ValueError(f"{reporting_line}: a rate must be above -1")
        out, factor = [], Decimal(1)
        with localcontext() as context:
            context.prec = 60
            for _ in range(months):
                factor = (factor * (1 + rate)).quantize(Decimal(1).scaleb(-PLACES), ROUND_HALF_UP)
                out.append(factor)
        if out and out[-1] >= LARGEST:
            raise ValueError(f"{reporting_line}: grows beyond {LARGEST} times")
        return out
