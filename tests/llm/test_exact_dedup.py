from __future__ import annotations

import re
from collections import defaultdict

from tests.llm.data import documents, texts
from tidebook.llm.exact_dedup import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(d)
    out = []
    for ids in groups.values():
        keep = min((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), d == keep) for d in ids]
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)


def test_awkward_rows(spark):
    frame = exact_dedup(documents(spark))
    assert found(frame) == expected(texts())
    assert {"text", "lang", "n", "words", "__row"} <= set(frame.columns)


def test_empty_table(spark):
    assert found(exact_dedup(documents(spark, []))) == []


def test_large_group_and_shared_prefixes(spark):
    rows = [(i, "same text " * 40) for i in range(700)] + [(1000 + i, "same text " * 40 + str(i)) for i in range(90)]
    assert found(exact_dedup(documents(spark, rows), prefix=8)) == expected(rows)


def test_no_python_in_the_plan(spark):
    plan = exact_dedup(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
