"""Money expressions.

Working amounts are ``decimal(18,2)``: decimal sums do not depend on the order
in which partitions arrive, double sums do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def whole_dollars(amount: Column) -> Column:
    """Round to whole dollars, an exact half going to the even neighbour.

    ``cast`` alone would truncate.
    """
    return F.bround(amount, 0).cast("bigint")


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def signed(amount: Column, direction: Column) -> Column:
    """Inflows keep their sign, everything else leaves the account."""
    return F.when(direction == "inflow", amount).otherwise(-amount)
