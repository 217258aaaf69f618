"""Python workers over two runs of the pipeline: one per slot, and none keeps what it used."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

import tidebook

psutil = pytest.importorskip("psutil")

SCRIPT = """
import json, os, sys
import psutil
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
import corpus_pipeline

spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
    .config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
for _ in range(2):
    rows = corpus_pipeline.run(spark, sys.argv[2]).count()

def daemon(process):
    return "pyspark.daemon" in " ".join(process.cmdline())

own = [p for p in psutil.Process(os.getpid()).children(recursive=True) if daemon(p)]
workers = [p for p in own if daemon(p.parent())]
print(json.dumps({"rows": rows, "workers": len(workers), "mb": max(p.memory_info().rss for p in workers) / 1e6}))
spark.stop()
"""


def test_two_runs_of_the_pipeline_leave_one_worker_per_slot(sf_dir):
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidebook.__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT, root, sf_dir], capture_output=True, text=True, timeout=1500)
    found = json.loads(done.stdout.strip().splitlines()[-1])
    assert found["rows"] > 0
    assert found["workers"] <= 2, found
    assert found["mb"] < 400, found
