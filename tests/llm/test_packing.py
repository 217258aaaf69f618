from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.data import documents, prose, texts
from tidebook.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected_pieces(rows, tokenizer):
    out = []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            piece = np.array(ids[at : at + 2048], "<u4")
            out.append((d, n, at, len(piece), zlib.crc32(piece.tobytes())))
    return sorted(out, key=repr)


def gapless(rows):
    """Every sequence is filled from 0 without gap or overlap, and not beyond the capacity."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by)


def test_awkward_rows(spark, tokenizer):
    rows = packing.pack(packing.token_pieces(documents(spark), PATH)).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected_pieces(texts(), tokenizer)
    assert gapless(rows) <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


@pytest.mark.parametrize("text", ["don't they'll 's", "naïve café—x ÀÉß ªº µm", "İstanbul ΣΑΣ. é", "a1b22\x1c3.5%\x85y", "x<|endoftext|>y", "### -- !?x"])
def test_words_as_the_tokenizer_has_them(tokenizer, text):
    (ids,) = packing.Tokens(PATH).of_texts(pa.array([text], pa.large_string()))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_exchange_between_partitions_with_gaps(spark):
    rng = np.random.RandomState(1)
    lengths = rng.choice([700, 900, 1100, 1400], 400).tolist()
    pieces = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, per_partition=10).collect()
    alone = packing.pack(pieces, per_partition=10, rounds=0).collect()
    assert sorted(r.doc_id for r in rows) == list(range(400))
    bound = packing.lower_bound(np.array(lengths), packing.CAPACITY)
    assert bound <= gapless(rows) < gapless(alone)


def test_bound_never_exceeds_a_packing_and_certifies():
    rng = np.random.RandomState(2)
    met = 0
    for k in range(60):
        lengths = rng.randint(1, 100 + 30 * k, rng.randint(1, 60)).clip(1, 2048)
        sequence, offset, n = packing.best_fit_decreasing(lengths, 2048)
        assert np.bincount(sequence, weights=lengths).max() <= 2048 and n == sequence.max() + 1
        bound = packing.lower_bound(lengths, 2048)
        assert lengths.sum() / 2048 <= bound + 1e-9 and np.ceil(bound - 1e-6) <= n
        met += np.ceil(bound - 1e-6) == n
    assert met > 45
    assert packing.lower_bound(np.array([1025] * 7), 2048) == 7
    assert packing.lower_bound(np.array([700] * 7), 2048) == 3.5


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(documents(spark, []), PATH)).collect() == []


def test_ids_of_other_types(spark):
    frame = spark.createDataFrame([("a", prose(1, 5))], "name string, body string")
    (row,) = packing.token_pieces(frame, PATH, "name", "body").collect()
    assert row.doc_id == "a" and row.piece == 0
