"""Order-free comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(record[i]) for i in order) for record in records)


def difference(frame, connection, sql: str) -> str | None:
    """None when equal, else a short account."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    expected = rows(names, result.fetchall())
    actual = rows(frame.columns, [tuple(r) for r in frame.collect()])
    if expected == actual:
        return None
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only here {list((actual - expected).items())[:3]}; "
        f"only there {list((expected - actual).items())[:3]}"
    )
