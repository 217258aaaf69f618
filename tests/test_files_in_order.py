"""Order read back from part files, files named by their records, scenario and amounts as gate rows."""

from __future__ import annotations

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests import sample
from tidebook.operators import checks, lineage
from tidebook.plans import staged_run
from tidebook.plans.scenario import ScenarioError
from tidebook.sources import cashbook
from tidebook.sources.extract import kept_records, priced_records
from tidebook.sources.files import file_order, read_csv_placed, write_csv


def placed(spark, folder, schema="k int, t string"):
    return file_order(read_csv_placed(spark, folder, schema), "k")


def test_ranks_over_several_files_and_splits(spark, tmp_path):
    rows = spark.range(3_000).selectExpr("CAST(id * 7919 % 3000 AS INT) AS k", "repeat('x', 30) AS t")
    write_csv(rows, str(tmp_path / "out"), "k", parts=6)
    assert len(glob.glob(f"{tmp_path}/out/part-*")) == 6
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several splits per file
    try:
        found = placed(spark, str(tmp_path / "out")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["rank"], r.k) for r in found) == [(i + 1, i) for i in range(3_000)]
    assert all(r.in_order for r in found)


def test_ten_files_follow_their_numbers(spark, tmp_path):
    write_csv(spark.range(240).selectExpr("CAST(id AS INT) AS k", "'' AS t"), str(tmp_path / "out"), "k", parts=12)
    assert all(r["rank"] == r.k + 1 for r in placed(spark, str(tmp_path / "out")).collect())


def test_rows_out_of_order_are_marked_inside_a_file_and_at_its_border(spark, tmp_path):
    folder = tmp_path / "out"
    folder.mkdir()
    for name, keys in (("part-00000-a.csv", [1, 3, 2]), ("part-00001-a.csv", [1, 5]), ("part-00002-a.csv", []), ("part-00003-a.csv", [5])):
        (folder / name).write_text("k,t\n" + "".join(f"{k},x\n" for k in keys))
    found = sorted((r["rank"], r.k, r.in_order) for r in placed(spark, str(folder)).collect())
    assert found == [(1, 1, True), (2, 3, True), (3, 2, False), (4, 1, False), (5, 5, True), (6, 5, True)]


def test_no_task_sees_all_rows(spark, tmp_path):
    write_csv(spark.range(50).selectExpr("CAST(id AS INT) AS k", "'' AS t"), str(tmp_path / "out"), "k", parts=3)
    plan = placed(spark, str(tmp_path / "out"))._jdf.queryExecution().executedPlan().toString()
    single = plan.index("Exchange SinglePartition")
    # What goes to one task has been added up by split before.
    assert "HashAggregate" in plan[single:] or "SortAggregate" in plan[single:]
    assert plan.count("Exchange SinglePartition") == 1


def test_extract_of_many_files(spark, tmp_path):
    folder = sample.write(tmp_path)
    whole = f"{folder}/raw/operating_payments.csv"
    header, *lines = open(whole).read().splitlines()
    os.remove(whole)
    os.mkdir(whole)
    for i in range(3):
        with open(f"{whole}/month-{i}.csv", "w") as file:
            file.write("\n".join([header, *lines[i::3]]) + "\n")
    for quarantine in (False, True):
        files = cashbook.CashbookFiles(spark, folder, quarantine=quarantine, with_files=True)
        by_file = {r.source_file: r["count"] for r in kept_records(files.extracts()).groupBy("source_file").count().collect()}
        assert by_file == {"month-0.csv": 6, "month-1.csv": 6, "month-2.csv": 6, "bitcoin_sales.csv": 9,
                           "capital_payments.csv": 10, "loan_draws.csv": 3}
    plain = cashbook.CashbookFiles(spark, folder)
    names = {r[0] for r in kept_records(plain.extracts()).select("source_file").distinct().collect()}
    assert "operating_payments.csv" in names and len(names) == 4
    inputs = sample.inputs(spark, folder)
    files = cashbook.CashbookFiles(spark, folder, with_files=True)
    lines_ = staged_run.stage(inputs, str(tmp_path / "tiers")).lines
    ledger_ = staged_run.stage(inputs, str(tmp_path / "more")).actuals
    traced = lineage.trace(files.extracts(), files.mapping(), ledger_, lines_, with_file=True)
    assert traced.filter("source_file LIKE 'month-%'").count() == 18


SCENARIO = "scenario string, fiscal_year int, actual_months int, forecast_months int"


@pytest.mark.parametrize(
    ("rows", "failed"),
    [
        ([("9+12", 2026, 9, 12)], []),
        ([], ["scenario_rows"]),
        ([("9+12", 2026, 9, 12)] * 2, ["scenario_rows"]),
        ([(" 8+12 ", 2026, 9, 12)], ["scenario_name"]),
        ([("13+12", 2026, 13, 12)], ["scenario_months"]),
        ([("9+0", 2026, 9, 0)], ["scenario_months"]),
        ([(None, None, 9, 12)], ["scenario_complete"]),
        ([("9+12", 2026, None, 12)], ["scenario_complete"]),
    ],
)
def test_scenario_gates(spark, tmp_path, rows, failed):
    table = spark.createDataFrame(rows, SCENARIO)
    found = checks.scenario_checks(table)
    assert found.count() == 4
    assert [r.check_id for r in found.filter("NOT passed").orderBy("ord").collect()] == failed
    out = str(tmp_path / "out")
    if not failed:
        assert staged_run.checked_scenario(spark, table, out).name == "9+12" and not os.path.exists(out)
        return
    with pytest.raises(checks.GateFailure) as failure:
        staged_run.checked_scenario(spark, table, out)
    assert failure.value.check_id == failed[0]
    (written,) = glob.glob(f"{out}/runs/*/checks")
    assert spark.read.parquet(written).count() == 4
    with pytest.raises(ScenarioError):
        staged_run.Scenario.from_frame(table)


PRICED = "transaction_id string, quantity decimal(19,8), unit_price decimal(18,4), amount decimal(18,2)"


def test_amounts_and_products(spark):
    from decimal import Decimal as D

    rows = [
        ("exact", D("2.5"), D("10"), D("25")), ("half up", D("0.005"), D("1"), D("0.01")), ("a cent", D("1"), D("1"), D("1.01")),
        ("far", D("1"), D("1"), D("3")), ("none", None, None, D("3")), ("half", D("1"), None, D("3")), ("no amount", D("1"), D("1"), None),
        ("large", D("99999999999.12345678"), D("99999.9999"), D("9999999990012345.67")),
    ]
    table = spark.createDataFrame(rows, PRICED)
    found = {r.transaction_id: (r.outcome, r.off_cents) for r in checks.amount_identity(table, 1).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        "exact": "agrees", "half up": "agrees", "a cent": "agrees", "far": "differs", "none": "no price",
        "half": "one factor missing", "no amount": "differs", "large": "differs",
    }
    assert found["a cent"][1] == 1 and found["far"][1] == 200
    product = (D("99999999999.12345678") * D("99999.9999")).quantize(D("0.01"))
    assert found["large"][1] == (D("9999999990012345.67") - product) * 100
    (gate,) = checks.amount_checks_by_record(table, 0).collect()
    assert gate.violations == 5 and gate.sample_key == "a cent" and not gate.passed


def test_sample_amounts_are_products(spark, tmp_path):
    rows = sample.tables()
    assert checks.amount_checks_by_record(
        priced_records(cashbook.CashbookFiles(spark, sample.write(tmp_path / "a")).extracts())
    ).first().passed
    rows["raw/bitcoin_sales.csv"][0][5] = "1"
    found = checks.amount_checks_by_record(
        priced_records(cashbook.CashbookFiles(spark, sample.write(tmp_path / "b", rows)).extracts())
    ).first()
    assert (found.violations, found.passed, found.sample_key) == (1, False, rows["raw/bitcoin_sales.csv"][0][0])


def test_feeds_without_prices_have_nothing_to_check(spark, tmp_path):
    extracts = cashbook.CashbookFiles(spark, sample.write(tmp_path)).extracts()[2:]
    with pytest.raises(ValueError):
        priced_records(extracts)
    shutil.rmtree(tmp_path, ignore_errors=True)
