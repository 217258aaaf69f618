"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import connect, difference

QUERIES = {query.__name__: query for query in registry.QUERIES}
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() == 25 * 21
