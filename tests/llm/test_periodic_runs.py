from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, texts
from tidebook.llm import periodic_runs, registry


def brute_runs(words):
    """All runs by scanning every period, and asking whether a smaller one holds."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(rows):
    out = []
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", t or "")
        n, h = len(words), 1 if d is None else zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = brute_runs(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept))
        out.append((d, len(runs), *strongest, *digests))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, registry.runs_as_rows(frame).collect()), key=repr)


def planted(rng, n):
    """Words of a small alphabet with cycles of cycles among them."""
    words = []
    while len(words) < n:
        root = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        block = root * rng.randint(1, 6)
        if rng.random() < 0.4:
            block = (block + [rng.choice("abcx")]) * rng.randint(1, 5)
        words += block[: rng.randint(1, len(block))] + [f"w{rng.randint(0, 30)}"] * rng.randint(0, 2)
    return words[:n]


@pytest.mark.parametrize("seed", range(150))
def test_runs_of_several_texts(seed):
    rng = random.Random(seed)
    parts = [planted(rng, rng.randint(0, 120)) for _ in range(4)]
    number = {w: i for i, w in enumerate(sorted({w for p in parts for w in p}))}
    bounds = np.cumsum([0, *map(len, parts)])
    codes = np.array([number[w] for p in parts for w in p], np.int64)
    wanted = [(s + int(b), n, q) for b, p in zip(bounds, parts) for s, n, q in brute_runs(p)]
    assert list(map(tuple, periodic_runs.runs_of(codes, bounds).tolist())) == wanted


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_the_scan_is_exact_on_any_segments(monkeypatch, rounds):
    monkeypatch.setattr(periodic_runs, "ROUNDS", rounds)
    for seed in range(20):
        words = planted(random.Random(1000 + seed), 100)
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64)
        assert list(map(tuple, periodic_runs.runs_of(codes, np.array([0, len(words)])).tolist())) == brute_runs(words)


def test_splitting_keeps_only_words_that_are_often_in_their_segment():
    words = "a b a b c a b a b d x x x x x x y a b a b a b a b".split()
    codes = np.unique(words, return_inverse=True)[1].astype(np.int64)
    place, head = periodic_runs.surviving(codes, np.zeros(len(words), np.int64))
    assert place.tolist() == [*range(10, 16), *range(17, 25)] and sorted(set(head.tolist())) == [10, 17]


def test_awkward_rows(spark):
    rows = texts() + [(400 + i, " ".join(planted(random.Random(i), 30 + i % 90))) for i in range(120)]
    rows = [(d, t) for d, t in rows if t is None or len(t) < 20_000]
    frame = periodic_runs.find_runs(documents(spark, rows), seed=periodic_runs.cycle_seed("doc_id"))
    assert found(frame) == expected(rows)
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows)


def test_long_text_of_nested_cycles(spark):
    base = [f"w{i}" for i in range(700)]
    words = (base * 400 + ["stop"]) * 5 + [f"u{i}" for i in range(200_000)]
    frame = periodic_runs.find_runs(documents(spark, [(3, " ".join(words)), (4, None)]), with_text=True)
    row = frame.filter("doc_id = 3").first().runs
    block = 700 * 400 + 1
    inner = [(i * block, block - 1, 700) for i in range(5)]
    assert [tuple(s) for s in row.spans] == sorted([(0, 5 * block, block), *inner], key=lambda s: (s[0], s[2]))
    assert row.collapsed.split() == base + ["stop"] + words[5 * block :]


def test_empty_table_and_other_columns(spark):
    frame = periodic_runs.find_runs(documents(spark, []).withColumn("runs", F.lit(1)))
    assert frame.columns == [*documents(spark, []).columns, "runs"] and frame.collect() == []
