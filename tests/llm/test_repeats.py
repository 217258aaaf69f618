"""The two operators on repeated windows, against every window of every document."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import documents, prose, texts
from tidebook.llm import repeats, substring_dedup, suffix_dedup

SMALL = ({}, {"chunk_bytes": 20_000}, {"chunk_bytes": 3_000, "hot": 2})
LAST = float("inf")


def bytes_expected(rows, window=50):
    first: dict[bytes, float] = {}
    coded = [(LAST if d is None else d, d, (t or "").encode()) for d, t in rows]
    for order, _, data in coded:
        for i in range(len(data) - window + 1):
            s = data[i : i + window]
            first[s] = min(first.get(s, LAST), order)
    out = []
    for order, d, data in coded:
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            if first[data[i : i + window]] < order:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words_expected(rows, window=35):
    split = [(d, re.findall(r"[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    count = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("dealing", SMALL)
def test_bytes(spark, dealing):
    assert found(suffix_dedup.remove_repeated_bytes(documents(spark), **dealing)) == bytes_expected(texts())


@pytest.mark.parametrize("dealing", SMALL)
def test_words(spark, dealing):
    assert found(substring_dedup.remove_repeated_words(documents(spark), **dealing)) == words_expected(texts())


def test_common_passage_in_different_contexts(spark):
    passage = prose(50, 60)
    rows = [(i, f"{prose(1000 + i, 30)} {passage} {prose(5000 + i, 30)}") for i in range(120)]
    small = {"chunk_bytes": 6_000, "hot": 3}
    assert found(suffix_dedup.remove_repeated_bytes(documents(spark, rows), **small)) == bytes_expected(rows)
    assert found(substring_dedup.remove_repeated_words(documents(spark, rows), **small)) == words_expected(rows)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeated_bytes(documents(spark, [])).collect() == []
    assert substring_dedup.remove_repeated_words(documents(spark, [])).collect() == []


def test_corpus_order_is_the_order_of_the_suffixes():
    rng = np.random.RandomState(3)
    parts = [rng.randint(97, 100, n).astype(np.uint8) for n in (90, 200, 60, 200)]
    parts += [parts[1][20:150], parts[1].copy()]
    text, bounds = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
    windows = np.concatenate([np.arange(a, b - 49) for a, b in zip(bounds[:-1], bounds[1:])])
    order = suffix_dedup.corpus_order(text, bounds, windows, 50)
    cut = [text[w : w + 50].tobytes() for w in windows[order]]
    assert cut == sorted(cut)


def test_fm_index_counts_patterns():
    rng = np.random.RandomState(4)
    symbols = rng.randint(1, 5, 400)
    symbols[[100, 250, 399]] = 0
    index = substring_dedup.FMIndex(symbols, 5, 400)
    joined = "".join(map(str, symbols))
    for a in range(0, 380, 7):
        pattern = symbols[a : a + rng.randint(1, 8)]
        if 0 in pattern:
            continue
        low, high = np.zeros(1, np.int64), np.full(1, len(symbols))
        for s in pattern[::-1]:
            low, high = index.extend(np.array([s]), low, high)
        needle = "".join(map(str, pattern))
        assert high[0] - low[0] == sum(joined.startswith(needle, i) for i in range(len(joined)))


def test_words_are_cut_at_document_borders():
    import pyarrow as pa

    units = repeats.word_units(pa.array(["", "ab", "cd e ", " f", "", "g"], pa.large_string()))
    words = [units.data[a:b].tobytes() for a, b in zip(units.begins, units.ends)]
    assert words == [b"ab", b"cd", b"e", b"f", b"g"]
    assert units.bounds.tolist() == [0, 0, 1, 3, 4, 4, 5]
