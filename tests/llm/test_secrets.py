from __future__ import annotations

import random
import re
import string

import pytest

from tests.llm.data import documents, prose, texts
from tidebook.llm import secrets


@pytest.fixture(scope="module")
def model(spark):
    return secrets.RatioModel.fit(secrets.labelled_samples(spark, documents(spark)))


def base(text):
    """The three rules as they are stated, one match after the other."""
    rules = [
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8),
        (r"AKIA[A-Z0-9]+", 0, 0, 16),
        (r"[0-9a-f]+", 0, 0, 32),
    ]
    out = []
    for kind, (pattern, flags, group, least) in enumerate(rules):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


CASES = [
    'token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" and Password: hunter2222',
    "token: secret: abcdefgh12345 passwd='short' API_KEY=abc.def/ghi=",
    "AKIAAKIAAKIAAKIA AKIASHORT AKIA" + "Z9" * 40 + "a",
    "é" * 50 + "0123456789abcdef" * 3 + "g deadbeef" + "A" * 40,
    "apikey:=x secret==================== ſecret=longenough1",
    "İ" * 20 + "Secret = abcdefghijk",
]


@pytest.mark.parametrize("text", CASES)
def test_rules(text):
    assert secrets.rule_spans(text) == base(text)


def test_random_strings_against_identifiers(model):
    rng = random.Random(99)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits + "+/", k=rng.randint(24, 60))) for _ in range(500)]
    names = ["_".join(rng.choice(prose(i, 6).lower().replace(",", "").split()) for _ in range(5)) for i in range(500)]
    names = [re.sub("[^a-z_]", "", n) for n in names]
    assert sum(map(model.is_secret, keys)) >= 495
    assert sum(map(model.is_secret, names)) <= 5


def test_awkward_rows(spark, model):
    key = "Zx8qLk2Vb9TnRw4Yc7Pd1Gf6Hj3M"
    rows = texts() + [(500, f"see {key} here, not the_long_identifier_name_of_it"), (501, f"token={key}")]
    frame = secrets.find_secrets(documents(spark, rows), model)
    got = {}
    for r in frame.select("doc_id", "text", "found.spans").collect():
        spans = [(s.start, secrets.KINDS.index(s.kind), s.stop) for s in r.spans]
        assert spans == sorted(spans)
        assert [s for s in spans if s[1] < 3] == base(r.text or "")
        got[r.doc_id] = [(r.text[s[0] : s[2]], s[1]) for s in spans]
    assert got[500] == [(key, 3)]
    assert got[501] == [(f"token={key}", 0)]
    assert got[17] == []


def test_empty_table_and_one_sided_sample(spark):
    lone = spark.createDataFrame([("abcDEF123", True)], "token string, is_secret boolean")
    model = secrets.RatioModel.fit(lone)
    assert not model.is_secret("Zx8qLk2Vb9TnRw4Yc7Pd1Gf6Hj3M")
    assert secrets.find_secrets(documents(spark, []), model).collect() == []


def keys(alphabet: str, size: int, n: int = 400) -> list[str]:
    rng = random.Random(size)
    return ["".join(rng.choices(alphabet, k=size)) for _ in range(n)]


@pytest.mark.parametrize("alphabet", [string.ascii_letters, string.ascii_letters + string.digits])
@pytest.mark.parametrize(("size", "share"), [(12, 0.8), (16, 0.95), (20, 0.98), (24, 0.99), (40, 0.99)])
@pytest.mark.parametrize("before", ["", "www-very/long/path_of/the-server/where_it/stands/"])
def test_keys_of_letters_short_ones_and_those_in_paths(model, alphabet, size, share, before):
    found = 0
    for key in keys(alphabet, size):
        text = f"é see {before}{key} there"
        found += any(text[a:b].endswith(key) and k == 3 for a, k, b in secrets.spans_of(text, model))
    assert found >= share * 400


def test_words_and_numbers_are_no_secrets(model):
    plain = "2024 2024-05-17 1234567890123 +49 711 1234567 (509) 555-1234 COVID-19 ISO-8859-1 192.168.10.24 12.5% A4 I a == = -- //"
    assert secrets.spans_of(plain, model) == []
    assert sum(len(secrets.spans_of(prose(i, 2_000), model)) for i in range(50)) == 0


def test_tokens_by_vector_are_those_by_pattern(model, monkeypatch):
    """Whole tokens against a scan by a regular expression, at any size of pieces."""
    rng = random.Random(5)
    for n in range(300):
        text = "".join(rng.choices("aZ9+/_-= é日^.\n", weights=[9, 9, 9, 1, 2, 2, 2, 3, 2, 1, 1, 1, 1, 1], k=rng.randint(0, 80)))
        whole = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_-]+={0,2}", text) if model.is_secret(m[0])]
        assert model.secrets_in(text)[0] == whole
        got = secrets.spans_of(text, model)
        assert got == sorted(set(got))
        assert all(a >= c for (_, _, c), (a, _, _) in zip(got, got[1:]))
        monkeypatch.setattr(secrets, "PIECE", 7)
        assert secrets.spans_of(text, model) == got
        monkeypatch.undo()


def test_padded_keys(model):
    for key in keys(string.ascii_letters + string.digits + "+/", 30, 100):
        assert [(a, b) for a, _, b in secrets.spans_of(f"a {key}== b", model)] == [(2, 34)]


def test_uncovered_parts_beside_a_rule(model):
    key = "Zx8qLk2Vb9TnRw4Yc7Pd1Gf6Hj3M"
    text = f"the/path/{'0123456789abcdef' * 2}/{key}"
    assert [(k, text[a:b]) for a, k, b in secrets.spans_of(text, model)] == [(2, "0123456789abcdef" * 2), (3, key)]
