"""Queries against their SQL where the tables are dirty, and what the gates then say."""

from __future__ import annotations

import glob
import os
import shutil

import duckdb
import pytest

import __spark_entry__ as registry
from tests.compare import connect, difference

QUERIES = {query.__name__: query for query in registry.QUERIES}
SQL = registry.oracle_sql()

ALTERED = {
    "null_line_number": ("lineitem", "SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber) FROM t"),
    "repeated_customer": ("customer", "SELECT * FROM t UNION ALL SELECT * REPLACE ((c_nationkey + 1) % 25 AS c_nationkey) FROM t WHERE c_custkey % 9 = 0"),
    "status_text": ("lineitem", "SELECT * REPLACE (CASE WHEN l_linestatus = 'F' AND l_orderkey % 2 = 0 THEN ' f ' ELSE l_linestatus END AS l_linestatus) FROM t"),
    "missing_supplier": ("supplier", "SELECT * FROM t WHERE s_suppkey > 3"),
    "null_nation": ("customer", "SELECT * REPLACE (CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey) FROM t"),
}
CHECKED = {
    "null_line_number": ("canonical_ledger", "id_audit", "duplicate_line_ids", "trace_ids", "check_report"),
    "repeated_customer": (
        "canonical_ledger", "id_audit", "control_totals_agree", "repeated_dimension_keys", "trace_ids", "check_report",
    ),
    "status_text": ("canonical_ledger", "id_audit", "control_totals_agree", "control_totals_unexpected"),
    "missing_supplier": (
        "balance_rollforward", "recon_line", "trace_selected", "trace_line_sum", "id_presence", "check_report",
    ),
    "null_nation": ("balance_rollforward", "recon_line", "check_report"),
}


@pytest.fixture(scope="module", params=list(ALTERED))
def altered(request, sf_dir, tmp_path_factory):
    table, sql = ALTERED[request.param]
    folder = str(tmp_path_factory.mktemp(request.param))
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        target = f"{folder}/{os.path.basename(path)}"
        if os.path.basename(path) == f"{table}.parquet":
            duckdb.sql(f"COPY (WITH t AS (FROM '{path}') {sql}) TO '{target}' (FORMAT parquet)")
        else:
            shutil.copy(path, target)
    return request.param, folder


def test_equal_to_their_sql(spark, altered):
    name, folder = altered
    duck = connect(folder)
    found = {query: difference(QUERIES[query](spark, folder), duck, SQL[query]) for query in CHECKED[name]}
    assert {query: text for query, text in found.items() if text} == {}


FAILS = {
    "null_line_number": {"repeated_transaction_id"},
    "repeated_customer": {"repeated_dimension_key", "repeated_transaction_id", "control_operating_inflow", "control_all_net"},
    "status_text": set(),
    "missing_supplier": {"missing_entity", "missing_counterparty", "one_opening_record"},
    "null_nation": {"missing_entity"},
}


def test_the_gates_that_fail(spark, altered):
    failed = registry.check_report(spark, altered[1]).filter("NOT passed").collect()
    found = {r["check_id"] for r in failed}
    assert FAILS[altered[0]] <= found
    if altered[0] == "status_text":
        assert not found


def test_every_booked_row_is_reported(spark, altered):
    """Rows without an entity are reported too, together."""
    outcomes = {r[0] for r in registry.trace_ids(spark, altered[1]).select("outcome").distinct().collect()}
    assert "not reported" not in outcomes
