"""``python -m tidebook DATA_DIR OUT_DIR``: run the cash-flow folder end to end.

Figures agreed beforehand are read from ``reporting/agreed_figures.csv``; a run that
differs from them publishes nothing, and a run without the file says so in its checks.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidebook.plans import staged_run
from tidebook.session import settings
from tidebook.sources import cashbook
from tidebook.sources.files import size_of


def main(
    data_dir: str,
    out_dir: str,
    allowed_rejects: int | None = None,
    amount_tolerance: int | None = None,
    id_buckets: int = 0,
) -> None:
    spark = SparkSession.builder.appName("tidebook").getOrCreate()
    cores = spark.sparkContext.defaultParallelism
    for key, value in settings(size_of(spark, data_dir), cores).items():
        spark.conf.set(key, value)
    files = cashbook.CashbookFiles(spark, data_dir, quarantine=allowed_rejects is not None)
    scenario = staged_run.checked_scenario(spark, files.scenario_table(), out_dir)
    inputs = staged_run.Inputs(
        extracts=files.extracts(),
        mapping=files.mapping(),
        bank=files.bank(),
        scenario=scenario,
        lines=cashbook.LINES,
        vendor_sources=cashbook.VENDOR_SOURCES,
        plan=files.plan(),
        expectations=files.expectations(),
        single_entity=True,
        rejects=files.rejects(),
        allowed_rejects=allowed_rejects or 0,
        amount_tolerance_cents=amount_tolerance,
        id_buckets=id_buckets,
    )
    tables = staged_run.run(spark, inputs, out_dir)
    staged_run.export_csv(tables, f"{out_dir.rstrip('/')}/csv/{tables.run_id}", inputs.single_entity)
    print(f"published run {tables.run_id}")


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("data_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--allowed-rejects", type=int, help="set unreadable records apart, and allow so many of them")
    parser.add_argument("--amount-tolerance", type=int, help="cents by which an amount may differ from quantity x price")
    parser.add_argument("--id-buckets", type=int, default=0, help="folders of a ledger tier laid out by id")
    main(**vars(parser.parse_args()))
