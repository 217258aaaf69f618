from __future__ import annotations

import json
import re

import pyarrow as pa
import pytest

from tests.llm.data import documents, prose, texts
from tidebook.llm import decontaminate as d


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(rows, items, window=10):
    out = []
    for doc, text in rows:
        words, hit, ids = split(text), set(), set()
        for item, item_text in items:
            w = split(item_text)
            m = min(window, len(w))
            patterns = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
            for i in range(len(words)):
                if m and tuple(words[i : i + m]) in patterns:
                    hit |= set(range(i, i + m))
                    ids.add(item)
        out.append((doc, len(words), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.select("doc_id", "words", "hits", "items").collect()
    return sorted(((r[0], r[1], sum(s.stop - s.start for s in r[2]), r[3]) for r in rows), key=repr)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [
    (1, prose(1, 80)),
    (2, "one, TWO"),
    (3, None),
    (4, "..."),
    (5, prose(2, 300).split(" ", 7)[7]),
    (10, prose(1, 80)),
    (None, "ünïcødé naïve"),
    (7, "日本語"),
    (8, "a a a a a a a a a a a a"),
    (9, "x y x y x y x y x y x y x"),
]


def test_awkward_rows(spark):
    rows = texts() + [(900, "x y " * 9), (901, "y " + "x y " * 9), (902, "ONE...two-one two")]
    searched = d.decontaminate(documents(spark, rows), items(spark, ITEMS))
    assert found(searched) == expected(rows, ITEMS)
    assert {"text", "kept", "__row"} <= set(searched.columns)


def in_blocks(monkeypatch, limit, stretch=d.STRETCH):
    whole = d.item_blocks
    monkeypatch.setattr(d, "STRETCH", stretch)
    monkeypatch.setattr(d, "item_blocks", lambda b, i, t, w: whole(b, i, t, w, limit=limit))


@pytest.mark.parametrize(("limit", "stretch"), [(1_000, 4_096), (300, 7), (1 << 20, 3)])
def test_items_in_blocks_and_stretches(spark, monkeypatch, limit, stretch):
    in_blocks(monkeypatch, limit, stretch)
    rows = texts() + [(900, "x y " * 9), (None, "x y " * 9), (902, "ONE...two-one two")]
    searched = d.decontaminate(documents(spark, rows), items(spark, ITEMS))
    assert found(searched) == expected(rows, ITEMS)
    assert {"text", "kept", "__row"} <= set(searched.columns) and "__number" not in searched.columns


def test_blocks_are_bounded(spark):
    rows = [(i, prose(i, 200)) for i in range(300)] + [(i, prose(0, 200)) for i in range(300)] + [(7, prose(1, 60_000))]
    blocks = list(d.item_blocks(items(spark, rows), "item_id", "text", 10, limit=40_000))
    assert len(blocks) > 10 and max(b.nbytes for b in blocks) < 300_000
    assert sum(b.num_rows for b in blocks) == 299 + 300 + 15  # equal rows are one, the long one is in stretches


def test_long_text_with_a_passage_at_its_end(spark):
    text = prose(50, 300_000) + " " + ITEMS[0][1]
    (row,) = found(d.decontaminate(documents(spark, [(1, text)]), items(spark, ITEMS)))
    assert row[1] == 300_080 and row[2] >= 80 and {"1", "10"} <= set(row[3])


def test_empty_tables(spark):
    assert found(d.decontaminate(documents(spark, []), items(spark, ITEMS))) == []
    assert found(d.decontaminate(documents(spark), items(spark, []))) == expected(texts(), [])


def test_shifts_skip_what_no_pattern_has():
    search = d.Search(pa.table({"item": ["1"], "words": ["a b c d e f g h i j".split()]}))
    m, block, shift, bucket, patterns, *_ = search.groups[0]
    assert (m, block, len(shift), len(bucket), len(patterns)) == (10, 2, 9, 1, 1)
    assert sorted(shift.values()) == list(range(9))


def test_spans_are_merged_alike(spark):
    from pyspark.sql import functions as F

    for spans in ([], [(3, 5)], [(5, 9), (0, 2), (2, 4), (8, 11)], [(0, 10), (2, 3), (10, 12), (14, 15)]):
        row = spark.range(1).select(
            d._merged_spans(F.from_json(F.lit(json.dumps([{"start": a, "stop": b} for a, b in spans])), "array<struct<start:long,stop:long>>")).alias("s")
        ).first()
        assert [tuple(s) for s in row.s] == d.merged(spans)
