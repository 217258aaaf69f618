"""One raw extract and how its columns become ledger columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import MONEY, text_literal
from tidebook.sources.ids import IdFormat

# Rows of no entity are reported together under this name, and a gate counts them.
UNKNOWN_ENTITY = "unknown"
# Their product has at most 38 digits and keeps every decimal place of both.
QUANTITY = "decimal(19,8)"
UNIT_PRICE = "decimal(18,4)"


@dataclass(frozen=True)
class Extract:
    """All fields but ``frame`` and ``kept_status`` are SQL expressions over ``frame``.

    ``source``, ``source_system``, ``source_file`` and ``direction`` may be
    constants or depend on the row, so one scan can feed several sources.
    ``record_id`` must be NULL when a part of the id is; the id gate counts those.
    ``id_format``: how the id is made of columns of ``frame``, where lookups are to
    prune by them. ``quantity`` and ``unit_price``: what the amount is the product of,
    where the feed has both.
    """

    frame: DataFrame
    source: str
    source_system: str
    source_file: str
    entity_id: str
    record_id: str
    category: str
    vendor: str
    event_date: str
    direction: str
    amount: str
    status: str
    kept_status: str
    id_format: IdFormat | None = None
    quantity: str | None = None
    unit_price: str | None = None

    def for_ids(self, ids: Iterable[str]) -> Extract:
        """Only the records of some ids, asked of the file scan by their keys."""
        ids = list(ids)
        if self.id_format is None:
            return replace(self, frame=self.frame.filter(F.expr(self.record_id).isin(ids)))
        return replace(self, frame=self.frame.filter(self.id_format.predicate(ids)))

    def priced_records(self, scenario=None) -> DataFrame:
        """Kept records with quantity, unit price and amount, all of them exact decimals."""
        frame = self.frame
        if scenario is not None:
            frame = frame.filter(scenario.closed(F.expr(self.event_date)))
        return frame.filter(f"coalesce(upper(trim({self.status})) = {text_literal(self.kept_status)}, false)").selectExpr(
            f"coalesce(CAST({self.entity_id} AS STRING), '{UNKNOWN_ENTITY}') AS entity_id",
            f"{self.record_id} AS transaction_id",
            f"{self.source} AS source",
            f"{self.category} AS source_category",
            f"CAST({self.event_date} AS DATE) AS cash_date",
            f"{self.direction} AS cash_direction",
            f"CAST({self.quantity or 'NULL'} AS {QUANTITY}) AS quantity",
            f"CAST({self.unit_price or 'NULL'} AS {UNIT_PRICE}) AS unit_price",
            f"CAST({self.amount} AS {MONEY.simpleString()}) AS amount",
        )

    def records(self, scenario=None) -> DataFrame:
        """Every record in the canonical shape, those with other statuses too.

        With a scenario, only its closed window is read: the range predicate
        sits on the raw date column, where the file scan can use it.
        """
        frame = self.frame
        if scenario is not None:
            frame = frame.filter(scenario.closed(F.expr(self.event_date)))
        status = f"upper(trim({self.status}))"
        return frame.selectExpr(
            f"coalesce(CAST({self.entity_id} AS STRING), '{UNKNOWN_ENTITY}') AS entity_id",
            f"{self.record_id} AS transaction_id",
            f"{self.source_system} AS source_system",
            f"{self.source_file} AS source_file",
            f"{self.source} AS source",
            f"{self.category} AS source_category",
            f"{self.vendor} AS vendor",
            f"CAST({self.event_date} AS DATE) AS cash_date",
            f"{self.direction} AS cash_direction",
            f"CAST({self.amount} AS {MONEY.simpleString()}) AS amount",
            f"{status} AS status",
            f"coalesce({status} = {text_literal(self.kept_status)}, false) AS kept",
        )

    def kept_records(self, scenario=None) -> DataFrame:
        return self.records(scenario).filter("kept").drop("status", "kept")


def all_records(extracts: Sequence[Extract], scenario=None) -> DataFrame:
    return reduce(DataFrame.unionByName, [e.records(scenario) for e in extracts])


def kept_records(extracts: Sequence[Extract], scenario=None) -> DataFrame:
    return reduce(DataFrame.unionByName, [e.kept_records(scenario) for e in extracts])


def priced_records(extracts: Sequence[Extract], scenario=None) -> DataFrame:
    """Kept records of the extracts whose feeds have quantity and price."""
    priced = [e for e in extracts if e.quantity and e.unit_price]
    if not priced:
        raise ValueError("no extract declares quantity and unit price")
    return reduce(DataFrame.unionByName, [e.priced_records(scenario) for e in priced])
