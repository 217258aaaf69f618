"""Language ID by unigram models of pieces, summed over all segmentations of a word.

The pieces are those of a public byte-level vocabulary (a path parameter), all of
them. Each language has a probability per piece. A word, with a blank before it, can
be cut into pieces in many ways; its probability in a language is the sum over all
of them, which the forward algorithm adds up from left to right. A text's score is
the sum over its words plus the language's prior.

Words are runs of letters in lower case, of any length: where blanks are not written
a whole sentence is one. The sums are scaled every ``RESCALED`` bytes, so that none
vanishes, and a word of more than ``RUN`` bytes is summed run by run, where the sums
at the last places of a run, as many as the longest piece has bytes, open the next.
Segmentations cross all of these borders. Words are summed at the same time, place by
place, in portions of ``CELLS`` sums; a word that a task has met is not summed again.

Training is expectation maximisation over counted words: Spark sums the expected
uses of each piece (forward and backward over all segmentations), the driver
divides them; what it gets is bounded by vocabulary times languages. The sample
is about ``SAMPLE_DOCUMENTS`` documents per language, or all if there are fewer,
taken by a hash of the id, without their words of more than ``SAMPLE_WORD``
characters; priors count all labelled documents.

Defined cases: a null text, or one without letters, is ``und`` with score 0, and
so is every text when no labelled text was learned from. A null label is not
learned from. Equal texts get equal results; of languages with equal scores the
first by name wins. Texts may be of any length. Columns of the input stay;
``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import common

UND = "und"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
RESCALED = 16
RUN = 1 << 15
CELLS = 1 << 19
KNOWN_WORDS = 200_000
SAMPLE_DOCUMENTS = 600
SAMPLE_WORD = 1_000
ROUNDS = 4
SMOOTHING = 0.05
SLICE_BYTES = 1 << 20
PREDICTED = "struct<lang_pred:string,score:double>"
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def read_vocabulary(path: str) -> list[bytes]:
    """All pieces; every single byte is among them."""
    with open(path, "rb") as lines:
        pieces = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    return sorted(pieces | {bytes([b]) for b in range(256)})


def _numbers_at(data: bytes) -> np.ndarray:
    """The eight bytes from each place on as a number; zero bytes follow the last."""
    return np.ndarray(len(data), np.dtype("<u8"), data + bytes(8), strides=(1,))


def _eights(size: int) -> list[int]:
    """Where stretches of eight bytes begin that together cover ``size`` bytes."""
    return [*range(0, size - 8, 8), size - 8]


def _combined(numbers: np.ndarray) -> np.ndarray:
    factors = common.mixed(np.arange(1, numbers.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    return common.mixed(numbers * factors).sum(axis=1, dtype=np.uint64)


@dataclass
class Pieces:
    """Pieces found by their bytes, one sorted table per length.

    Up to eight bytes the key is the bytes as a number. Longer ones are looked up by a hash
    of the numbers that cover them, where the last eight bytes end some long piece, and
    then all numbers are compared.
    """

    keys: dict[int, np.ndarray]
    numbers: dict[int, np.ndarray]
    covers: dict[int, np.ndarray]
    tails: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes]) -> Pieces:
        keys, numbers, covers, tails = {}, {}, {}, [np.empty(0, np.uint64)]
        for n in sorted({len(p) for p in pieces}):
            own = np.array([i for i, p in enumerate(pieces) if len(p) == n], np.int64)
            at = [0] if n <= 8 else _eights(n)
            cover = np.array([[int.from_bytes(pieces[i][a : a + 8], "little") for a in at] for i in own], np.uint64)
            key = cover[:, 0] if n <= 8 else _combined(cover)
            order = np.argsort(key)
            keys[n], numbers[n] = key[order], own[order]
            if n > 8:
                covers[n] = cover[order]
                tails.append(cover[:, -1])
        return cls(keys, numbers, covers, np.unique(np.concatenate(tails)))

    def find(self, size: int, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Numbers of the pieces of ``size`` bytes that begin at ``start``, -1 where there is none."""
        keys = self.keys[size]
        if size <= 8:
            asked = value[start] & MASKS[size]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            return np.where(keys[at] == asked, self.numbers[size][at], -1)
        cover = np.stack([value[start + a] for a in _eights(size)], axis=1)
        asked = _combined(cover)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where((self.covers[size][at] == cover).all(axis=1), self.numbers[size][at], -1)

    def ends_long(self, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether the eight bytes from ``start`` on end a piece of more than eight bytes."""
        asked = value[start]
        at = np.minimum(np.searchsorted(self.tails, asked), len(self.tails) - 1) if len(self.tails) else None
        return np.zeros(len(start), bool) if at is None else self.tails[at] == asked


class Lattice:
    """All pieces at all places of many byte strings, longest strings first.

    Node t of a string is the place after its first t bytes. Nodes are numbered by
    t, then by string, so what is active at t is one stretch of them.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, pieces: Pieces):
        size = np.diff(bounds)
        self.order = np.argsort(-size, kind="stable")
        begin, self.size = bounds[:-1][self.order], size[self.order]
        self.longest = int(self.size[0]) if len(size) else 0
        self.active = np.searchsorted(-self.size, -np.arange(self.longest + 1), "right")
        self.level = np.concatenate([[0], np.cumsum(self.active)])
        depth = np.repeat(np.arange(self.longest + 1), self.active)
        string = np.arange(self.level[-1]) - self.level[depth]
        place = begin[string] + depth  # in the data, of the byte after the node
        value = _numbers_at(data.tobytes())
        #: (to, from, piece, where each level's edges begin), one entry per piece length that occurs
        self.edges: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.reach = 1
        ends_long = None
        for n in pieces.keys:
            if n > self.longest:
                break
            to = np.arange(self.level[n], self.level[-1])
            if n > 8:
                if ends_long is None:
                    eight = np.arange(self.level[8], self.level[-1])
                    ends_long = eight[pieces.ends_long(value, place[eight] - 8)]
                to = ends_long[np.searchsorted(ends_long, self.level[n]) :]
                if not len(to):
                    continue
            piece = pieces.find(n, value, place[to] - n)
            there = np.flatnonzero(piece >= 0)
            if len(there):
                to, piece = to[there], piece[there]
                back = self.level[depth[to] - n] + string[to]
                self.edges.append((to, back, piece, np.searchsorted(to, self.level)))
                self.reach = n

    @classmethod
    def of_words(cls, words: pa.Array, pieces: Pieces) -> Lattice:
        """Strings of one blank and a word each."""
        data, bounds = common.bytes_of(words)
        bounds = bounds + np.arange(len(bounds))
        spaced = np.full(bounds[-1], 32, np.uint8)
        inside = np.ones(len(spaced), bool)
        inside[bounds[:-1]] = False
        spaced[inside] = data
        return cls(spaced, bounds, pieces)

    def _rescale(self, value: np.ndarray, scale: np.ndarray, by: np.ndarray, levels: range, n: int) -> None:
        """Divides the sums of the first ``n`` strings at some levels, and notes that."""
        for t in levels:
            m = min(n, self.active[t])
            at = slice(self.level[t], self.level[t] + m)
            value[at] = np.minimum(value[at] / by[:m], 1e300)
            scale[at] += np.log(by[:m])

    def forward(self, odds: np.ndarray, given: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Summed probability of the bytes before each node, as (value, logarithm of its scale).

        ``given``: both at the first nodes of the only string.
        """
        value = np.zeros((self.level[-1], odds.shape[1]))
        scale = np.zeros_like(value)
        opened = 1
        if given is None:
            value[: self.active[0]] = 1
        else:
            opened = len(given[0])
            value[:opened], scale[:opened] = given
            scale[opened:] = scale[opened - 1]
        for t in range(opened, self.longest + 1):
            now = slice(self.level[t], self.level[t + 1])
            # The scale of a node is that of the string's node before.
            scale[now] = scale[self.level[t - 1] : self.level[t - 1] + self.active[t]]
            for to, back, piece, at in self.edges:
                a, b = at[t], at[t + 1]
                if a < b:
                    value[to[a:b]] += value[back[a:b]] * odds[piece[a:b]]
            if t % RESCALED == 0:
                self._rescale(value, scale, value[now].copy(), range(max(0, t - self.reach + 1), t + 1), self.active[t])
        return value, scale

    def backward(self, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed probability of the bytes after each node, as (value, logarithm of its scale)."""
        value = np.zeros((self.level[-1], odds.shape[1]))
        scale = np.zeros_like(value)
        value[self.last] = 1
        for t in range(self.longest, 0, -1):
            now, farthest = slice(self.level[t], self.level[t + 1]), t - self.reach
            if 0 <= farthest < t - 1:
                # The scale of a node is that of the string's node after.
                m = self.active[farthest + 1]
                above = self.level[farthest + 1]
                scale[self.level[farthest] : self.level[farthest] + m] = scale[above : above + m]
            if t % RESCALED == 0:
                self._rescale(value, scale, value[now].copy(), range(max(0, farthest), t + 1), self.active[t])
            for to, back, piece, at in self.edges:
                a, b = at[t], at[t + 1]
                if a < b:
                    step = np.exp(scale[to[a:b]] - scale[back[a:b]])
                    value[back[a:b]] += value[to[a:b]] * odds[piece[a:b]] * step
        return value, scale

    @property
    def last(self) -> np.ndarray:
        return self.level[self.size] + np.arange(len(self.size))

    def scores(self, odds: np.ndarray) -> np.ndarray:
        """Logarithm of each string's summed probability, in the order the strings were given."""
        out = np.empty((len(self.size), odds.shape[1]))
        value, scale = self.forward(odds)
        out[self.order] = np.log(value[self.last]) + scale[self.last]
        return out

    def expected(self, odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece per language; counts per string and language."""
        uses = np.zeros_like(odds)
        if not self.longest:
            return uses
        alpha, up = self.forward(odds)
        beta, down = self.backward(odds)
        counts = counts[self.order]
        total = np.log(alpha[self.last]) + up[self.last]
        depth = np.repeat(np.arange(self.longest + 1), self.active)
        for to, back, piece, _ in self.edges:
            string = to - self.level[depth[to]]
            share = np.exp(up[back] + down[to] - total[string])
            np.add.at(uses, piece, counts[string] * share * alpha[back] * odds[piece] * beta[to])
        return uses


def _long_score(word: bytes, pieces: Pieces, odds: np.ndarray) -> np.ndarray:
    """As ``Lattice.scores`` for one word, run by run."""
    data, done = np.frombuffer(b" " + word, np.uint8), 0
    reach = max(pieces.keys)
    given = None
    while done < len(data):
        first = max(0, done - reach)
        stop = min(done + RUN, len(data))
        lattice = Lattice(data[first:stop], np.array([0, stop - first]), pieces)
        lattice.reach = reach  # the next run may have longer pieces than this one
        value, scale = lattice.forward(odds, given)
        done = stop
        given = value[-reach - 1 :], scale[-reach - 1 :]
    return np.log(value[-1]) + scale[-1]


def portions(words: pa.Array, cells: int) -> Iterator[tuple[int, int]]:
    """Stretches of words of about that many bytes."""
    ends = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 2)
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + cells, "right")))
        yield start, stop
        start = stop


def word_scores(words: pa.Array, pieces: Pieces, odds: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability per language."""
    out = np.empty((len(words), odds.shape[1]))
    for a, b in portions(words, max(1, CELLS // max(odds.shape[1], 1))):
        part = words.slice(a, b - a)
        if b - a == 1 and pc.binary_length(part)[0].as_py() > RUN:
            out[a] = _long_score(part[0].as_py().encode(), pieces, odds)
        else:
            out[a:b] = Lattice.of_words(part, pieces).scores(odds)
    return out


def lettered(texts: pa.Array) -> pa.Array:
    """Lower-case letters, and one blank for each run of anything else."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"\PL+", " ")


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    odds: np.ndarray
    prior: np.ndarray


class Scorer:
    """A model at work in one task; scores of words seen lately are kept, at most ``KNOWN_WORDS``."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = np.empty((0, len(self.model.languages)))

    def _per_word(self, words: pa.Array) -> np.ndarray:
        names = words.to_pylist()
        if len(self.place) + len(names) > KNOWN_WORDS:
            self._forget()
        fresh = [i for i, w in enumerate(names) if w not in self.place]
        if fresh:
            found = word_scores(words.take(pa.array(fresh)), self.model.pieces, self.model.odds)
            self.place.update((names[i], len(self.held) + k) for k, i in enumerate(fresh))
            self.held = np.concatenate([self.held, found])
        return self.held[[self.place[w] for w in names]]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        languages, found, scores = self.model.languages, [], []
        for part in common.slices(texts, SLICE_BYTES):
            codes, bounds, words = common.split_words(lettered(part))
            per_text = np.zeros((len(part), len(languages)))
            if len(codes) and languages:
                per_word = self._per_word(words)
                full = np.flatnonzero(np.diff(bounds))
                for k in range(len(languages)):
                    per_text[full, k] = np.add.reduceat(per_word[codes, k], bounds[full])
            total = per_text + self.model.prior
            empty = (np.diff(bounds) == 0) | (not languages)
            best = total.argmax(axis=1) if languages else np.zeros(len(part), int)
            top = total.max(axis=1, keepdims=True) if languages else total
            share = 1 / np.exp(total - top).sum(axis=1) if languages else np.zeros(len(part))
            found += [UND if e else languages[b] for e, b in zip(empty, best)]
            scores.append(np.where(empty, 0.0, share))
        return found, np.concatenate(scores) if scores else np.empty(0)


def _expected_uses(languages: list[str], pieces: Pieces, odds: np.ndarray):
    kind = pa.schema([("piece", pa.int64()), ("uses", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros_like(odds)
        number = {name: k for k, name in enumerate(languages)}
        for batch in batches:
            words = batch.column(0).cast(pa.large_string())
            counts = np.zeros((len(words), len(languages)))
            which = [number[x] for x in batch.column(1).to_pylist()]
            counts[np.arange(len(words)), which] = batch.column(2).to_numpy()
            for a, b in portions(words, max(1, CELLS // len(languages))):
                uses += Lattice.of_words(words.slice(a, b - a), pieces).expected(odds, counts[a:b])
        used = np.flatnonzero(uses.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(list(uses[used]), kind.types[1])], schema=kind)
        common.release()

    return run


def _updated(expected: DataFrame, odds: np.ndarray) -> np.ndarray:
    """Probabilities by the expected uses, one row per piece that is used."""
    sums = [F.sum(F.col("uses")[k]).alias(f"u{k}") for k in range(odds.shape[1])]
    found = expected.groupBy("piece").agg(*sums).toArrow()
    uses = np.zeros_like(odds)
    uses[found.column(0).to_numpy()] = np.stack([c.to_numpy() for c in found.columns[1:]], axis=1)
    return (uses + SMOOTHING) / (uses + SMOOTHING).sum(axis=0)


def train(
    docs: DataFrame,
    vocabulary: list[bytes],
    text_col: str = "text",
    lang_col: str = "lang",
    pick: Column | None = None,
    sample: int = SAMPLE_DOCUMENTS,
    rounds: int = ROUNDS,
) -> LanguageModel:
    """``pick``: a hashed number per row, by which about ``sample`` rows per language are taken."""
    common.ship(docs.sparkSession)
    docs = docs.select(
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        (F.xxhash64(text_col) if pick is None else pick).alias("pick"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], Pieces.of(vocabulary), np.zeros((len(vocabulary), 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(1e9 * min(1.0, sample / totals[k])))])
    chosen = docs.filter(F.pmod("pick", F.lit(1_000_000_000)) < F.element_at(share, F.col("lang")))
    word = F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("word")
    taken = (F.col("word") != "") & (F.length("word") <= SAMPLE_WORD)
    counted = common.stored(chosen.select(word, "lang").filter(taken).groupBy("word", "lang").count(), "langid-words")
    pieces = Pieces.of(vocabulary)
    odds = np.full((len(vocabulary), len(languages)), 1 / len(vocabulary))
    for _ in range(rounds):
        expected = counted.mapInArrow(_expected_uses(languages, pieces, odds), "piece long, uses array<double>")
        odds = _updated(expected, odds)
    seen = np.array([totals[k] for k in languages], float)
    return LanguageModel(languages, pieces, odds, np.log(seen / seen.sum()))


def fold(id_col: str) -> Column:
    """The remainder that sets documents apart: 2 is held out. A null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, the share of that language among all."""

    @F.arrow_udf(PREDICTED)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            found, scores = scorer.predict(texts)
            yield pa.StructArray.from_arrays(
                [pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )
            pa.default_memory_pool().release_unused()
        del scorer
        common.release()

    common.ship(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    judged = docs.withColumn("__judged", predict(F.col(text_col)))
    return judged.select(*docs.columns, "__judged.lang_pred", "__judged.score")
