"""Each stage against plain Python on what its predecessor kept, and the whole run."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tests.llm.data import documents, edited, prose, texts
from tests.llm.test_decontaminate import expected as decontaminated
from tests.llm.test_near_dedup import expected as near
from tidebook.llm import langid

LEAK = prose(77, 40)


def rows():
    base = prose(60, 200)
    more = [(700 + i, edited(base, i, i)) for i in range(6)] + [(720, f"{prose(61, 30)} {LEAK} {prose(62, 30)}")]
    return texts() + more


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows()).write.parquet(f"{path}/documents.parquet")
    items = spark.createDataFrame([(1, LEAK), (2, None), (3, prose(78, 12))], "item_id long, text string")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage returns, in order."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, stage(spark, docs, folder))
        path = f"{folder}/{name}"
        out[name][1].write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (out[name][0], docs)
    return out


def pairs(frame):
    return sorted(((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()), key=repr)


def test_order_and_columns(kept):
    assert list(kept) == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for name, (before, after) in kept.items():
        if name != "packing":
            assert after.dtypes == before.dtypes


def test_language_stage_keeps_all_that_has_a_language(kept):
    before, after = map(pairs, kept["language_id"])
    assert after == [r for r in before if re.search("[^\\W\\d_]", r[1] or "")]


def test_exact_stage(kept):
    before, after = map(pairs, kept["exact_dedup"])
    first = {}
    for d, t in before:
        key = re.sub(r"[\x20\x09-\x0d]+", " ", t)
        first[key] = min((x for x in (first.get(key), d) if x is not None), default=None)
    assert after == [(d, t) for d, t in before if first[re.sub(r"[\x20\x09-\x0d]+", " ", t)] == d]


def test_near_stage(kept):
    before, after = map(pairs, kept["near_dedup"])
    found = near(before, 5, 80)
    dropped = {d for d, _, _, k in found if not k and d is not None}
    assert after == [(d, t) for d, t in before if d not in dropped]
    assert len(after) < len(before)


def test_decontamination_stage(kept):
    before, after = map(pairs, kept["decontamination"])
    found = decontaminated(before, [("1", LEAK), ("3", prose(78, 12))])
    hit = {d for d, _, n, _ in found if n}
    assert 720 in hit and after == [(d, t) for d, t in before if d not in hit]


def test_packing_stage_has_every_document(kept):
    before, after = kept["packing"]
    assert {r.doc_id for r in before.select("doc_id").collect()} == {r.doc_id for r in after.select("doc_id").collect()}


def test_run_is_the_stages_in_order(spark, folder, kept):
    whole = corpus_pipeline.run(spark, folder)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, whole.select(*columns).collect()), key=repr) == sorted(
        map(tuple, kept["packing"][1].select(*columns).collect()), key=repr
    )


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_held_out_rows_are_not_learned_from(spark):
    docs = documents(spark)
    assert {r[0] for r in docs.select(langid.fold("doc_id")).distinct().collect()} <= {0, 1, 2, 3}
