from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tests.llm.data import WORDS, documents, texts
from tidebook.llm import divergence
from tidebook.llm.divergence import UNIT

ROWS = [(i, t, (None, "", "en", "de")[i % 4 if i % 7 else 2], (None, "", "a", "b", "c")[i * i % 5]) for i, (_, t) in enumerate(texts())]


def expected(rows, min_docs=3, top=200):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(t or ""))) for _, t, lang, source in rows]
    seen, count = Counter(), defaultdict(Counter)
    for lang, source, words in terms:
        seen.update((lang, w) for w in set(words))
        count[lang, source].update(words)
    out = []
    for lang in {x for x, _ in count}:
        kept = [w for (x, w), n in seen.items() if x == lang and n >= min_docs]
        groups = {s: c for (x, s), c in count.items() if x == lang}

        def probabilities(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + UNIT * (c[w] + 1) // (n + len(kept)) for w in kept}

        p = {s: probabilities(c) for s, c in groups.items()}
        q = probabilities(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept)) for o in groups if o != s]
            own = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", own, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items)]
    return sorted(out)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def table(spark, rows):
    frame = documents(spark, [(d, t) for d, t, _, _ in rows]).drop("lang")
    named = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return named.withColumns({c: named.doc_id.cast("string") for c in frame.columns if c not in named.columns} | {"count": named.doc_id})


@pytest.mark.parametrize("small", [False, True])
def test_awkward_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK_POSTINGS", 50), ("CHUNK_POSTINGS", 3), ("PAIR_BLOCK", 5), ("HELD_PAIRS", 4), ("MERGED_POSTINGS", 10)):
            monkeypatch.setattr(divergence, name, value)
    found = divergence.divergence(table(spark, ROWS))
    assert sorted(map(tuple, found.collect())) == expected(ROWS)


def test_many_sources_and_a_hot_one(spark):
    rng = random.Random(4)
    rows = [
        (i, " ".join(rng.choices(WORDS, k=rng.randint(0, 12))), "en", "hot" if i % 3 == 0 else f"s{rng.randint(0, 60)}")
        for i in range(900)
    ]
    assert sorted(map(tuple, divergence.divergence(table(spark, rows), top=7).collect())) == expected(rows, top=7)


def test_no_term_is_kept(spark):
    rows = [(1, "one two", "en", "a"), (2, "one", "en", "b"), (3, None, "en", None), (4, "one one one", "fr", "a")]
    found = divergence.divergence(table(spark, rows))
    assert sorted(map(tuple, found.collect())) == expected(rows) and found.filter("part = 'term' OR value <> 0").count() == 0


def test_empty_table(spark):
    assert divergence.divergence(table(spark, [])).collect() == []


def test_runs_are_sorted_and_merged_by_term(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_POSTINGS", 4)
    rng, blocks, wanted = random.Random(1), [], defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for _ in range(6):
        block = divergence.Block(3)
        for _ in range(20):
            words = rng.choices(WORDS, k=30)
            lang, source = rng.choice(["x", "y"]), rng.choice("abc")
            block.add(pa.array([" ".join(words)], pa.large_string()), [lang], [source])
            for w in {*words, divergence.OCCURS}:
                wanted[lang, w][source][0] += words.count(w)
                wanted[lang, w][source][1] += 1
        run = list(block.runs())
        keys = [(c["shard"], c["lang"], t) for c in run for t in c["terms"]]
        assert keys == sorted(keys)
        blocks += run
    chunks = sorted(blocks, key=lambda c: (c["shard"], c["lang"], c["first"]))
    kinds = divergence.chunk_schema()
    for step in (1, 30, 10_000):
        batches = [pa.RecordBatch.from_pylist(chunks[i : i + 7], kinds) for i in range(0, len(chunks), 7)]
        found = defaultdict(dict)
        for part in divergence.merged(divergence._chunks(iter(batches)), step):
            terms = set()
            for lang, term, source, count, docs in zip(*(part[c].to_pylist() for c in ("lang", "term", "source")), part["count"].tolist(), part["docs"].tolist()):
                assert source not in found[lang, term]
                found[lang, term][source] = [count, docs]
                terms.add((lang, term))
            assert len(part["starts"]) == len(terms)
        assert found == {k: dict(v) for k, v in wanted.items()}


def test_a_term_in_all_chunks_is_added_up_while_they_come():
    import numpy as np

    def chunk():
        return divergence._Open(0, "x", ["t"], np.array([0, 3]), pa.array(["a", "b", "c"]), np.array([1, 2, 3]), np.array([1, 1, 1]))

    most = []

    def watched():
        for _ in range(5_000):
            yield chunk()

    original = divergence._compacted
    divergence._compacted = lambda heap: most.append(sum(x.held for _, _, x in heap)) or original(heap)
    try:
        (part,) = divergence.merged(watched(), 30)
    finally:
        divergence._compacted = original
    assert part["count"].tolist() == [5_000, 10_000, 15_000] and max(most) < 100


def test_totals_beyond_64_bits(spark):
    """Probabilities are exact where UNIT times the count no longer fits a long."""
    from pyspark.sql import functions as F

    big = 90_000_000_000
    row = spark.range(1).select(divergence.probability(F.lit(big), F.lit(7 * big), F.lit(13)).alias("p")).first()
    assert row.p == 1 + UNIT * (big + 1) // (7 * big + 13)
