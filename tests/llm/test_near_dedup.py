from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import documents, edited, prose, texts
from tidebook.llm import near_dedup


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0d]+", lowered(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def expected(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        least = min((x for x in ids[root(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_awkward_rows(spark, width, percent):
    assert found(near_dedup.near_dedup(documents(spark), width=width, percent=percent)) == expected(texts(), width, percent)


def test_dense_group_of_near_copies(spark, monkeypatch):
    """Similarities on both sides of the threshold, links that only chains of copies make."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    base = prose(9, 150)
    rows = [(500 - i, edited(base, 40 + i, 2 + i % 12)) for i in range(110)]
    rows += [(900 + i, prose(200 + i, 50)) for i in range(20)]
    assert found(near_dedup.near_dedup(documents(spark, rows), width=3, percent=85)) == expected(rows, 3, 85)


def test_empty_table(spark):
    assert found(near_dedup.near_dedup(documents(spark, []))) == []


def test_components_by_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 100), (60, 60), (70, 80), (90, 80)]
    frame = near_dedup.components(spark.createDataFrame(pairs, "a long, b long"))
    found_ = dict(map(tuple, frame.collect()))
    assert found_ == {i: 0 for i in range(41)} | {60: 60, 100: 60, 70: 70, 80: 70, 90: 70}


def test_odd_sketch_estimates_and_bound():
    left = prose(3, 600)
    for n in (0, 10, 25):
        right = edited(left, n, n)
        a, b = near_dedup.signatures(pa.array([left, right], pa.large_string()), 3, 5, 24)
        x, y = shingles(left, 3), shingles(right, 3)
        true = len(x & y) / len(x | y)
        sketches = [np.frombuffer(s["sketch"], np.uint64)[None] for s in (a, b)]
        assert abs(near_dedup.estimate(near_dedup.differing(*sketches))[0] - true) < 0.12
        parities = [np.frombuffer(s["parity"], np.uint64)[None] for s in (a, b)]
        assert near_dedup.differing(*parities)[0] <= len(x ^ y)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bands_miss_fewer_than_one_in_a_million(percent):
    rows, bands = near_dedup.band_shape(percent)
    assert rows * bands <= near_dedup.SAMPLES
    assert (1 - (percent / 100) ** rows) ** bands < 1e-6


@pytest.mark.parametrize("known", [0, 64])
def test_buckets_of_lone_templates_are_dealt_in_bounded_blocks(spark, monkeypatch, known):
    """Most members share bands without a link, so nearly a whole bucket is lone."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "KNOWN", known)
    sizes, dealt = [], near_dedup._Nodes.dealt

    def spied(self, parts, refuted):
        rows = dealt(self, parts, refuted)
        sizes.extend(r["count"] for r in rows.groupBy("key", "lone_block", "block", "lone").count().collect())
        return rows

    monkeypatch.setattr(near_dedup._Nodes, "dealt", spied)
    template = prose(900, 160)
    rows = [(i, edited(template, i, 6 + i % 9)) for i in range(150)]
    rows += [(500 + i, edited(rows[i * 7][1], 700 + i, 1)) for i in range(20)]
    assert found(near_dedup.near_dedup(documents(spark, rows), width=3, percent=85)) == expected(rows, 3, 85)
    assert sizes and max(sizes) <= 3 * 16


def dealt_rows(monkeypatch, run) -> list[int]:
    """How many rows each round sends to be compared."""
    sizes, dealt = [], near_dedup._Nodes.dealt

    def spied(self, parts, refuted):
        rows = dealt(self, parts, refuted)
        sizes.append(rows.count())
        return rows

    with monkeypatch.context() as patched:
        patched.setattr(near_dedup._Nodes, "dealt", spied)
        run()
    return sizes


def slots(rows, width, percent):
    """Rows of all buckets of at least three members."""
    signed = near_dedup.signatures(pa.array([t for _, t in rows], pa.large_string()), width, *near_dedup.band_shape(percent))
    keys = Counter(key for one in signed for key in one["bands"])
    return sum(n for n in keys.values() if n > 2)


def test_rows_of_a_bucket_that_fits_a_block_are_sent_once_and_settled_ones_not_again(spark, monkeypatch):
    """A template under the threshold, and few copies: most members never have a pair that may be linked."""
    template = prose(900, 160)
    rows = [(i, edited(template, i, 6 + i % 9)) for i in range(150)]
    rows += [(500 + i, edited(rows[i * 7][1], 700 + i, 1)) for i in range(20)]

    def run():
        assert found(near_dedup.near_dedup(documents(spark, rows), width=3, percent=85)) == expected(rows, 3, 85)

    sizes = dealt_rows(monkeypatch, run)
    assert 0 < sizes[0] <= slots(rows, 3, 85)
    assert sum(sizes[1:]) < sizes[0]


def test_rows_sent_grow_with_a_group_of_near_copies_and_not_with_its_square(spark, monkeypatch):
    """All are linked with texts that are no hubs, and hardly any with each other."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    base, sent = prose(9, 300), []
    for n in (80, 320):
        rows = [(i, edited(base, 40 + i, 6)) for i in range(n)] + [(5000 + i, edited(base, 9000 + i, 1)) for i in range(n // 8)]

        def run(rows=rows):
            assert found(near_dedup.near_dedup(documents(spark, rows), width=3, percent=85)) == expected(rows, 3, 85)

        sizes = dealt_rows(monkeypatch, run)
        sent.append(sum(sizes) / slots(rows, 3, 85))
    assert max(sent) < 2, sent
