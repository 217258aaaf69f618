"""Secrets in texts: three fixed rules, and Markov models of characters for the rest.

Two models of character pairs, one of random strings and one of ordinary
identifiers and numbers, are counted in Spark from labelled samples. A token is a
secret when the logarithm of the ratio of its likelihoods under the two is high
enough. Every token is judged, whatever its length and characters. Of a token that
is none as a whole, the parts between ``/``, ``-`` and ``_`` are judged, those in turn
whose mean is high enough together, or else each alone.

The rules find their spans whatever the models say; the models add spans of kind
``random`` for tokens that no rule covers. Starts and ends count code points.

Defined cases: a null text counts as empty and has no spans. Rows are judged one
by one, so repeated rows repeat their result. With an empty or one-sided sample
both models are the same, and only the rules find anything. Texts may be of any
length; a long one is searched in pieces that cut no token. An empty table gives an
empty result. Columns of the input stay; ``found`` is replaced.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import common

# The rules, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
# A run is taken whole, so a minimum in the pattern finds what dropping short matches leaves.
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{HEX_MIN},}}")
KINDS = ("assign", "access", "hex", "random")

SEPARATORS = "/_-"
NO_TOKEN = re.compile(r"[^A-Za-z0-9+/_=-]")
PIECE = 1 << 20
ALPHABET = string.ascii_letters + string.digits + "+/_-="
SAMPLE_TOKENS = 20_000
SAMPLE_DOCUMENTS = 2_000
SEED = 7
#: A token is a secret when the ratio's logarithm reaches this sum and this mean per pair.
MIN_SUM, MIN_MEAN = 15.0, 0.5
BACK_OFF = 5.0
#: Part of the characters of tokens that may be any, which bounds what one pair can say.
ANY_SHARE = 0.02

FOUND = "struct<spans:array<struct<kind:string,start:long,stop:long>>>"


def random_strings(n: int = SAMPLE_TOKENS, seed: int = SEED) -> list[str]:
    """Strings labelled random: keys over the usual alphabets, from a seeded generator."""
    rng = random.Random(seed)
    alphabets = (
        string.hexdigits[:16],
        string.ascii_uppercase + string.digits,
        string.ascii_lowercase + string.digits,
        string.ascii_letters + string.digits,
        string.ascii_letters + string.digits + "+/",
    )
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 64))) for i in range(n)]


def labelled_samples(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, is_secret): generated keys, and identifiers of a bounded sample of documents.

    About ``SAMPLE_DOCUMENTS`` texts are taken by their hash, and ``SAMPLE_TOKENS`` of their words.
    Words of one case pattern, joined by nothing, ``_``, ``-`` or ``/``, stand for
    the names that programs and addresses have. Numbers drawn by the words' hashes,
    alone, as dates and after capitals, stand for those that texts have.
    """
    texts = docs.select(text_col).filter(F.col(text_col).isNotNull())
    share = int(1e9 * min(1.0, SAMPLE_DOCUMENTS / max(1, texts.count())))
    chosen = texts.filter(F.pmod(F.xxhash64(text_col), F.lit(1_000_000_000)) < share)
    word = F.explode(F.regexp_extract_all(text_col, F.lit(r"([A-Za-z]{4,})"), 1))
    words = chosen.select(word.alias("word")).distinct().orderBy(F.xxhash64("word"), "word")
    words = words.limit(SAMPLE_TOKENS)
    follower = F.reverse("word")

    def number(seed: int, most: int):
        """One to ``most`` digits."""
        size = F.pmod(F.xxhash64("word", F.lit(seed)), F.lit(most)).cast("int") + 1
        return F.substring(F.pmod(F.xxhash64("word", F.lit(-seed)), F.lit(10**12)).cast("string"), F.lit(1), size)

    joined = F.explode(
        F.array(
            F.col("word"),
            F.concat(F.lower("word"), F.initcap("word")),
            F.concat(F.lower("word"), F.lit("_"), F.lower("word")),
            F.concat(F.lower("word"), F.lit("/"), F.lower("word"), F.lit("-"), F.lower("word")),
            F.concat(F.upper("word"), F.lit("_"), F.upper("word")),
            F.concat(F.initcap("word"), F.initcap(follower), F.lit("2")),
            number(1, 12),
            F.concat(number(2, 4), F.lit("-"), number(3, 2), F.lit("-"), number(4, 2)),
            F.concat(F.upper(F.substring("word", 1, 3)), F.lit("-"), number(5, 6)),
        )
    )
    ordinary = words.select(joined.alias("token"), F.lit(False).alias("is_secret"))
    secret = spark.createDataFrame([(x, True) for x in random_strings()], "token string, is_secret boolean")
    return ordinary.unionByName(secret)


@dataclass(frozen=True)
class RatioModel:
    """Logarithms of the two likelihoods' ratio, by the codes of two characters in turn."""

    table: np.ndarray

    @classmethod
    def fit(cls, samples: DataFrame) -> RatioModel:
        """Pairs are counted in Spark; the counts are at most 2 * 68 * 67 rows."""
        token = F.concat(F.lit("^"), "token")
        pair = F.explode(
            F.transform(F.sequence(F.lit(1), F.length("token")), lambda i: F.substring(token, i, F.lit(2)))
        )
        usable = samples.filter(F.col("token").rlike(r"\A[A-Za-z0-9+/_=-]+\z"))
        counted = usable.select("is_secret", pair.alias("pair")).groupBy("is_secret", "pair").count()
        size = len(ALPHABET) + 1
        counts = np.zeros((2, size, size))
        code = {c: i for i, c in enumerate(ALPHABET)} | {"^": size - 1}
        for is_secret, pair_, n in counted.collect():
            counts[int(is_secret), code[pair_[0]], code[pair_[1]]] += n
        if (counts.sum(axis=(1, 2)) == 0).any():
            return cls(np.zeros((size, size)))
        # Pairs that a sample lacks get their second character's share in it.
        single = counts.sum(axis=1) + 1
        single /= single.sum(axis=1, keepdims=True)
        odds = (counts + BACK_OFF * single[:, None, :]) / (counts.sum(axis=2, keepdims=True) + BACK_OFF)
        # For what the samples lack, part of a token's characters may be any.
        odds = (1 - ANY_SHARE) * odds + ANY_SHARE / len(ALPHABET)
        return cls(np.log(odds[1] / odds[0]))

    def scores(self, token: str) -> tuple[float, float]:
        """Sum and mean over the token's pairs."""
        codes = CODES[np.frombuffer(("^" + token).encode(), np.uint8)]
        ratios = self.table[codes[:-1], codes[1:]]
        return float(ratios.sum()), float(ratios.mean())

    def is_secret(self, token: str) -> bool:
        total, mean = self.scores(token)
        return total >= MIN_SUM and mean >= MIN_MEAN

    def secrets_in(self, text: str) -> list[list[tuple[int, int]]]:
        """Bounds of secrets: whole tokens, then parts in turn, then parts alone."""
        # One byte per code point; what the alphabet lacks only ends tokens.
        data = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
        codes = CODES[data]
        kind = KIND[data]
        body = kind > 1
        starts = np.flatnonzero(body & ~_after(body))
        padding = (kind == 1) & _after(body)
        padding |= (kind == 1) & _after(padding)
        inside = body | padding
        last = np.ones(len(data), bool)
        last[:-1] = ~inside[1:] | (padding[:-1] & body[1:])
        stops = np.flatnonzero(inside & last) + 1
        before = _after(codes)
        before[starts] = BEGIN
        sums = np.zeros(len(data) + 1)
        sums[1:] = self.table[before, codes]
        sums[1:][~inside] = 0
        np.cumsum(sums, out=sums)
        first = self.table[BEGIN]

        def secret(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            total = sums[b] - sums[a + 1] + first[codes[a]]
            hot = total >= MIN_MEAN * (b - a)
            return hot, hot & (total >= MIN_SUM)

        whole = secret(starts, stops)[1]
        part = (kind == 3) | padding & ~_after(kind == 2)
        part_starts = np.flatnonzero((kind == 3) & ~_after(kind == 3))
        ends = np.ones(len(data), bool)
        ends[:-1] = ~part[1:] | (padding[:-1] & body[1:])
        part_stops = np.flatnonzero(part & ends) + 1
        part_stops = part_stops[np.searchsorted(part_stops, part_starts, "right")]
        hot, alone = secret(part_starts, part_stops)
        owner = np.searchsorted(starts, part_starts, "right")
        begins = hot & ~(_after(hot) & (_after(owner) == owner))
        finishes = np.ones(len(hot), bool)
        finishes[:-1] = ~hot[1:] | begins[1:]
        group_starts, group_stops = part_starts[begins], part_stops[hot & finishes]
        joined = secret(group_starts, group_stops)[1]
        bounds = (
            (starts[whole], stops[whole]),
            (group_starts[joined], group_stops[joined]),
            (part_starts[alone], part_stops[alone]),
        )
        return [list(zip(a.tolist(), b.tolist())) for a, b in bounds]


def _after(values: np.ndarray) -> np.ndarray:
    """For each place the value of the one before, and zero for the first."""
    moved = np.zeros_like(values)
    moved[1:] = values[:-1]
    return moved


CODES = np.zeros(256, np.uint8)
for _i, _c in enumerate(ALPHABET + "^"):
    CODES[ord(_c)] = _i
BEGIN = len(ALPHABET)
#: 3 in a part of a token, 2 between parts, 1 what may end a token, 0 no token.
KIND = np.zeros(256, np.uint8)
for _c in ALPHABET:
    KIND[ord(_c)] = 1 if _c == "=" else 2 if _c in SEPARATORS else 3


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the rules, kinds as numbers."""
    found, folded = [], text.lower()
    if any(key in folded for key in ("passw", "secret", "token", "api")):
        found += [(*_span(m, 0),) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [_span(m, 1) for m in ACCESS.finditer(text)]
    found += [_span(m, 2) for m in HEX.finditer(text)]
    return sorted(found)


def _span(match: re.Match, kind: int) -> tuple[int, int, int]:
    return match.start(), kind, match.end()


def _pieces(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about PIECE characters that cut no token."""
    start = 0
    while start < len(text):
        end = NO_TOKEN.search(text, min(start + PIECE, len(text)))
        stop = end.end() if end else len(text)
        yield start, stop
        start = stop


def spans_of(text: str, model: RatioModel) -> list[tuple[int, int, int]]:
    found = rule_spans(text)
    rule_starts = [start for start, _, _ in found]
    reached = list(accumulate((stop for _, _, stop in found), max))

    def free(start: int, stop: int) -> bool:
        k = bisect_left(rule_starts, stop)
        return not k or reached[k - 1] <= start

    for at, end in _pieces(text):
        taken: list[tuple[int, int]] = []
        for tokens in model.secrets_in(text[at:end]):
            added = []
            for start, stop in tokens:
                k = bisect_left(taken, (stop, 0))
                if free(at + start, at + stop) and not (k and taken[k - 1][1] > start):
                    added.append((start, stop))
            taken = sorted(taken + added)
        found += [(at + start, 3, at + stop) for start, stop in taken]
    return sorted(found)


def find_secrets(docs: DataFrame, model: RatioModel, text_col: str = "text") -> DataFrame:
    """The rows with ``found.spans``: kind, start and stop of each, by start, then kind."""

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        for texts in batches:
            rows = [
                {"spans": [{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in spans_of(t.as_py() or "", model)]}
                for t in texts
            ]
            yield pa.array(rows, pa.struct([("spans", pa.list_(kind_of))]))

    common.ship(docs.sparkSession)
    return docs.withColumn("found", found(F.col(text_col)))
