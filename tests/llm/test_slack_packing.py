from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.data import documents, prose, texts
from tidebook.llm import slack_packing

PATH = public_tokenizers.path(slack_packing.TOKENIZER)
CAPACITY = slack_packing.CAPACITY


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def audit(rows, tables, tokenizer):
    """Every id of every document in exactly one piece, places without gaps; number of unpadded ids."""
    wanted = Counter()
    for d, t in tables:
        wanted[d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    by_key = defaultdict(list)
    for (d, ids), n in wanted.items():
        by_key[d, len(ids)] += [ids] * n
    assert set(by_key) == set(pieces)
    for key, documents_ in by_key.items():
        got = sorted(pieces[key])
        if len(documents_) == 1:
            at = 0
            for start, length, crc in got:
                assert start == at and crc == zlib.crc32(np.array(documents_[0][at : at + length], "<u4").tobytes())
                at += length
            assert at == key[1]
        else:
            assert sum(length for _, length, _ in got) == key[1] * len(documents_)
            allowed = {(s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for ids in documents_ for s, n, _ in got}
            assert set(got) <= allowed
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= CAPACITY
        padding += 0 if at & (at - 1) == 0 else CAPACITY - at
    return padding


def test_awkward_rows(spark, tokenizer):
    rows = slack_packing.pack(slack_packing.token_pieces(documents(spark), PATH)).collect()
    assert audit(rows, texts(), tokenizer) == 0


@pytest.mark.parametrize("same", [True, False])
def test_several_rounds(spark, tokenizer, same):
    rng = random.Random(5)
    tables = [(i, prose(7 if same else i, 90 if same else rng.randint(1, 300))) for i in range(6_000)]
    found = slack_packing.pack(slack_packing.token_pieces(documents(spark, tables), PATH), per_partition=2_048)
    rows = found.collect()
    assert audit(rows, tables, tokenizer) == 0
    extra = len(rows) - sum(-(-n // CAPACITY) for n in {r.doc_id: r.doc_tokens for r in rows}.values())
    # Where lengths vary, exact fills are found; equal ones have to be cut, at most once a sequence.
    assert extra <= (len({r.sequence_id for r in rows}) + 12 if same else 60)


def test_fill_against_all_choices():
    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(0, 9))]
        room = rng.randint(0, 90)
        total, taken = slack_packing.fill(Counter(lengths), room)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= room)
        assert total == best == sum(n * k for n, k in taken.items())
        assert all(k <= lengths.count(n) for n, k in taken.items())


AWKWARD = [
    "don't they'll 's  \n\n  two\tthree \r\n four ",
    "naïve café — x ÀÉß ªº µm ÷ × 1²",
    "a  b   c   d　 e \u0085 f\x1c g \x0b h",
    "İstanbul ΣΑΣ. é 日本語 の テスト。 한국어 हिन्दी",
    "x<|endoftext|>y <|endoftext|> z",
    "a  b   c    ",
    "### -- !?x 12,5% 1a2b 'S 'll",
    "\x00 \x1f \x7f \U0001f600 x",
    "Ã a Â b Ó  c",
]


@pytest.mark.parametrize("text", AWKWARD)
def test_ids_as_the_tokenizer_has_them(tokenizer, text):
    (ids,) = slack_packing.Tokens(PATH).of_texts(pa.array([text], pa.large_string()))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_ids_of_random_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(slack_packing, "PORTION", 3)
    rng = random.Random(9)
    signs = " \n\t\r\x0b\x0c  　aäÃßé日のΣ1²½'.,-<|>\x00ts"
    made = ["".join(rng.choice(signs) * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(0, 40))) for _ in range(4_000)]
    for text, ids in zip(made, slack_packing.Tokens(PATH).of_texts(pa.array(made, pa.large_string()))):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_long_text(spark, tokenizer):
    text = prose(11, 400_000)
    rows = slack_packing.pack(slack_packing.token_pieces(documents(spark, [(1, text), (2, None)]), PATH)).collect()
    assert audit(rows, [(1, text), (2, None)], tokenizer) == 0


def test_empty_table_and_ids_of_other_types(spark):
    assert slack_packing.pack(slack_packing.token_pieces(documents(spark, []), PATH)).collect() == []
    frame = spark.createDataFrame([("a", prose(1, 5))], "name string, body string")
    rows = slack_packing.pack(slack_packing.token_pieces(frame, PATH, "name", "body")).collect()
    assert {r.doc_id for r in rows} == {"a"} and sum(r.length for r in rows) == rows[0].doc_tokens
