"""Ids that are made of keys, and back: from ids asked for to predicates on the keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import text_literal

#: More ids than this are joined instead of written into the plan.
LITERAL_IDS = 1_000
LIMITS = {"int": 31, "bigint": 63}


@dataclass(frozen=True)
class IdFormat:
    """An id written as a prefix and the values of key columns, with dashes between.

    ``keys`` are (column, ``int`` or ``bigint`` or ``string``). With a single string key
    and no prefix the id is that column.
    """

    prefix: str
    keys: tuple[tuple[str, str], ...]

    def expression(self) -> str:
        """SQL for the id; NULL when a part of it is."""
        names = [name for name, _ in self.keys]
        if not self.prefix and len(names) == 1:
            return names[0]
        first = text_literal(f"{self.prefix}-") if self.prefix else "''"
        return f"concat({first}, " + ", '-', ".join(names) + ")"

    def parse(self, an_id: str) -> tuple | None:
        """Key values of an id of this format, None for any other text."""
        if not self.prefix and len(self.keys) == 1 and self.keys[0][1] == "string":
            return (an_id,)
        part = {"int": "(0|-?[1-9][0-9]*)", "bigint": "(0|-?[1-9][0-9]*)", "string": "(.*?)"}
        shape = "-".join(([re.escape(self.prefix)] if self.prefix else []) + [part[kind] for _, kind in self.keys])
        found = re.fullmatch(shape, an_id, re.DOTALL)
        if not found:
            return None
        values = tuple(v if kind == "string" else int(v) for v, (_, kind) in zip(found.groups(), self.keys))
        fits = all(
            kind == "string" or -(1 << LIMITS[kind]) <= v < 1 << LIMITS[kind] for v, (_, kind) in zip(values, self.keys)
        )
        return values if fits else None

    def predicate(self, ids: Iterable[str]) -> Column:
        """Rows of the asked ids: key values the file scan can prune by, and the id itself.

        Of several keys each is asked to be among the asked values of its own; the id
        then tells their combinations apart.
        """
        wanted = sorted({i for i in ids if i is not None})
        parsed = [v for v in map(self.parse, wanted) if v is not None]
        if not parsed:
            return F.lit(False)
        among = [F.col(name).isin(sorted({v[k] for v in parsed})) for k, (name, _) in enumerate(self.keys)]
        return reduce(Column.__and__, among) & F.expr(self.expression()).isin(wanted)


def literal_ids(ids: DataFrame, limit: int = LITERAL_IDS) -> Sequence[str] | None:
    """The distinct ids of a frame if they are at most ``limit``, else None."""
    rows = ids.select("transaction_id").filter("transaction_id IS NOT NULL").distinct().take(limit + 1)
    return None if len(rows) > limit else sorted(r["transaction_id"] for r in rows)
