from __future__ import annotations

import itertools
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.data import CLASHES, DOCUMENTS
from tidebook.llm import langid


@pytest.fixture(scope="module")
def vocabulary():
    return langid.read_vocabulary(public_tokenizers.path(langid.VOCABULARY))


def summed(word: bytes, odds: dict[bytes, float]) -> float:
    """All segmentations, one by one."""
    total = 0.0
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        total += np.prod([odds.get(word[a:b], 0.0) for a, b in zip(at, at[1:])])
    return total


PIECES = [b"a", b"b", b" ", b"ab", b" a", b"ba", b"aba", b"bb"]
ODDS = np.array([[0.3, 0.1], [0.2, 0.1], [0.1, 0.2], [0.1, 0.1], [0.1, 0.3], [0.05, 0.1], [0.1, 0.05], [0.05, 0.05]])


def test_forward_sums_all_segmentations():
    words = pa.array(["ab", "abba", "b", "aababba"], pa.large_string())
    scores = langid.word_scores(words, langid.Pieces.of(PIECES), ODDS)
    for i, word in enumerate(words.to_pylist()):
        for k in range(2):
            expected = summed(b" " + word.encode(), dict(zip(PIECES, ODDS[:, k])))
            assert np.isclose(np.exp(scores[i, k]), expected)


def exact(word: bytes, pieces: list[bytes], odds: np.ndarray):
    """Forward and backward sums in whole fractions, and the expected uses of each piece."""
    odds = {p: Fraction(float(x)) for p, x in zip(pieces, odds)}
    n = len(word)
    alpha, beta = [Fraction(1)] + [Fraction(0)] * n, [Fraction(0)] * n + [Fraction(1)]
    for e in range(1, n + 1):
        alpha[e] = sum((alpha[b] * odds[word[b:e]] for b in range(max(0, e - 36), e) if word[b:e] in odds), Fraction(0))
    for b in range(n - 1, -1, -1):
        beta[b] = sum((beta[e] * odds[word[b:e]] for e in range(b + 1, min(n, b + 36) + 1) if word[b:e] in odds), Fraction(0))
    uses = dict.fromkeys(pieces, Fraction(0))
    for b in range(n):
        for e in range(b + 1, min(n, b + 36) + 1):
            if word[b:e] in odds:
                uses[word[b:e]] += alpha[b] * odds[word[b:e]] * beta[e] / alpha[n]
    return alpha[n], uses


def logarithm(x: Fraction) -> float:
    shift = x.denominator.bit_length() - x.numerator.bit_length()
    return float(np.log(float(x * 2**shift)) - shift * np.log(2))


LONG_PIECES = PIECES + [b"abababab", b"ababababa", b" ababababab", b"babababababababab", b"ab" * 12, b"a" * 20 + b"b", "語".encode(), "日本語".encode()] + [
    bytes([x]) for x in sorted(set("日本語".encode()))
]


@pytest.mark.parametrize("run", [1 << 15, 40, 3])
def test_long_pieces_words_and_runs(monkeypatch, run):
    monkeypatch.setattr(langid, "RUN", run)
    rng = np.random.RandomState(2)
    odds = rng.dirichlet(np.ones(len(LONG_PIECES)) * 0.5, size=3).T + 1e-7
    words = ["ab" * 9, "日本語" * 12, "a" * 25 + "b" * 40, "ab" * 70, "b", "日本" * 11 + "ababa", "a" * 20 + "b", "ab" * 100]
    held = pa.array(words, pa.large_string())
    monkeypatch.setattr(langid, "CELLS", 6 if run == 3 else langid.CELLS)
    scores = langid.word_scores(held, langid.Pieces.of(LONG_PIECES), odds)
    lattice = langid.Lattice.of_words(held, langid.Pieces.of(LONG_PIECES))
    for k in range(3):
        wanted = [exact(b" " + w.encode(), LONG_PIECES, odds[:, k]) for w in words]
        assert np.allclose(scores[:, k], [logarithm(total) for total, _ in wanted], rtol=1e-9)
        counts = np.zeros((len(words), 3))
        counts[:, k] = np.arange(1, len(words) + 1)
        uses = lattice.expected(odds, counts)[:, k]
        assert np.allclose(uses, [sum(float(u[p]) * (i + 1) for i, (_, u) in enumerate(wanted)) for p in LONG_PIECES])


def test_the_whole_vocabulary_is_found(vocabulary):
    pieces = langid.Pieces.of(vocabulary)
    data = b"".join(vocabulary)
    value, bounds = langid._numbers_at(data), np.cumsum([0, *map(len, vocabulary)])
    for n in pieces.keys:
        own = [i for i, p in enumerate(vocabulary) if len(p) == n]
        assert pieces.find(n, value, bounds[own]).tolist() == own
    assert max(pieces.keys) > 30 and len(vocabulary) >= 50_256


def test_expected_uses_are_those_of_all_segmentations():
    words = pa.array(["abba"], pa.large_string())
    uses = langid.Lattice.of_words(words, langid.Pieces.of(PIECES)).expected(ODDS, np.ones((1, 2)))
    odds, word = dict(zip(PIECES, ODDS[:, 0])), b" abba"
    total, counts = summed(word, odds), np.zeros(len(PIECES))
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        for p in parts:
            if p in odds:
                counts[PIECES.index(p)] += np.prod([odds.get(x, 0.0) for x in parts])
    assert np.allclose(uses[:, 0], counts / total)


def test_words_met_before_keep_their_scores(monkeypatch):
    monkeypatch.setattr(langid, "KNOWN_WORDS", 3)
    model = langid.LanguageModel(["x", "y"], langid.Pieces.of(PIECES), ODDS, np.zeros(2))
    scorer = langid.Scorer(model)
    for words in (["ab", "b"], ["b", "abba"], ["ab", "abba", "a", "bb"], ["b"]):
        own = scorer._per_word(pa.array(words, pa.large_string()))
        assert np.allclose(own, langid.word_scores(pa.array(words, pa.large_string()), model.pieces, ODDS))


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, lang, *CLASHES) for i, (t, lang) in enumerate(pairs)], DOCUMENTS)


ENGLISH = ["the house and the other things were there when they thought of it", "where is the weather that she has"]
GERMAN = ["das Haus und die anderen Sachen waren schön als sie darüber nachdachten", "wo ist das Wetter über dem Schiff"]


def test_awkward_rows(spark, vocabulary):
    labelled = [(t, "en") for t in ENGLISH * 5] + [(t, "de") for t in GERMAN * 5] + [(None, "en"), ("xyz", None), ("", "de")]
    model = langid.train(rows(spark, labelled), vocabulary, pick=F.xxhash64("doc_id"))
    asked = [("THE THING and the house", None), ("über das Schiff und die Sachen", "en"), (None, "en"), ("", "en"),
             ("123 !? \x00", "de"), ("the " * 50_000, None), ("x" * 5_000, None), ("日本語", None)]
    frame = langid.identify(rows(spark, asked), model)
    got = {r.doc_id: (r.lang_pred, r.score) for r in frame.select("doc_id", "lang_pred", "score").collect()}
    assert got[0][0] == "en" and got[1][0] == "de" and got[5][0] == "en"
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert all(0 <= s <= 1 and p in ("en", "de", "und") for p, s in got.values())
    assert {"lang", "spans", "__row"} <= set(frame.columns)


def test_nothing_to_learn_from(spark, vocabulary):
    model = langid.train(rows(spark, []).limit(0), vocabulary)
    got = langid.identify(rows(spark, [("some text", None)]), model).select("lang_pred", "score").collect()
    assert [tuple(r) for r in got] == [("und", 0.0)]
    assert langid.identify(rows(spark, []), model).collect() == []


def test_held_out_accuracy(spark, sf_dir, vocabulary):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs.filter(langid.fold("doc_id") != 2), vocabulary, pick=F.xxhash64("doc_id"))
    held = langid.identify(docs.filter((langid.fold("doc_id") == 2) & F.col("lang").isNotNull()), model)
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.97
