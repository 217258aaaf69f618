"""The registry where the text operators are not installed."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as registry

ROOT = os.path.dirname(os.path.abspath(registry.__file__))


@pytest.mark.parametrize("left", ["nothing", "an empty folder"])
def test_imports_without_the_text_operators(tmp_path, left):
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    if left != "nothing":
        (tmp_path / "repo/tidebook/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == [str(len(registry.QUERIES))] * 2


def test_nothing_else_imports_the_text_operators():
    for folder, _, names in os.walk(f"{ROOT}/tidebook"):
        if f"{ROOT}/tidebook/llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                assert "tidebook.llm" not in open(f"{folder}/{name}").read()
