"""Word sequences repeated anywhere in a corpus, removed by FM-indexes of its shards.

A word is removed when a window of 35 consecutive words that covers it also starts
anywhere else, in the same document or another. ``repeats`` brings all runs of
windows that may be equal into one shard and collapses runs that are the same. Each
shard builds an FM-index of its distinct runs (those that stand for several places
twice): the Burrows-Wheeler transform as a wavelet matrix of packed bits with
sampled counts. The runs are then streamed against it, all in step. Backward search
extends a match to the left while it occurs twice; where that fails the match is
maximal, a matching statistic, and the search goes on at the last window that the
failing word can be part of. Matches of at least a window are reported.

Words are compared by 64-bit hashes of their bytes.

Defined cases: a null text has no words; texts shorter than a window keep every
word. Rows that repeat a text remove each other's words, whatever their ids. A null
doc_id stays null. A text is cut into words by one task, with some 35 bytes of memory
per byte of it. An empty table gives an empty result. Other columns are not carried
along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidebook.llm import repeats
from tidebook.llm.repeats import Shape, Units

WINDOW = 35
GRAM = 16
KINDS = [("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")]


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit per level and place."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        places = np.arange(size)  # where an imagined symbol at place 0 ends up
        start = np.zeros(size, np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(np.append(bit, np.zeros(64 + (-len(bit)) % 64)).astype(np.uint8), bitorder="little")
            words = packed.view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append(np.cumsum(ones) - ones)
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
            rank = self._ones(len(self.words) - 1, start)
            start = np.where((places >> level) & 1, self.zeros[-1] + rank, start - rank)
        self.start = start

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        for i in range(self.bits):
            ones = self._ones(i, place)
            place = np.where((symbol >> (self.bits - 1 - i)) & 1, self.zeros[i] + ones, place - ones)
        return place - self.start[symbol]


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least, by doubling."""
    rank, step = symbols.astype(np.int64), 1
    n = len(symbols)
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        turn = np.append(0, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(turn)
        step *= 2
        if step >= depth or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Counts of patterns of at most ``depth`` symbols; 0 separates sequences."""

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        order = suffix_array(symbols, depth)
        self.size = len(symbols)
        self.matrix = WaveletMatrix(symbols[order - 1], size)
        self.before = np.append(0, np.cumsum(np.bincount(symbols, minlength=size)))[:-1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with a symbol and then what those from low to high begin with."""
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        both += np.concatenate([self.before[symbol]] * 2)
        return both[: len(symbol)], both[len(symbol) :]


def matches(index: FMIndex, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, window: int):
    """(pattern, start, stop) of every maximal match of a window or more that occurs twice."""
    active = np.flatnonzero(size >= window)
    stop = size[active].copy()
    at = stop.copy()
    low, high = np.zeros(len(active), np.int64), np.full(len(active), index.size)
    found = []
    while len(active):
        next_low, next_high = index.extend(symbols[begin[active] + at - 1], low, high)
        longer = next_high - next_low >= 2
        at = at - longer
        low, high = np.where(longer, next_low, 0), np.where(longer, next_high, index.size)
        ended = ~longer | (at == 0)
        report = ended & (stop - at >= window)
        found.append((active[report], at[report], stop[report]))
        # A word that fails ends every longer match; the next window with it before its end begins the search anew.
        stop = np.where(ended, np.minimum(stop - 1, at - 1 + window), stop)
        at = np.where(ended, stop, at)
        low, high = np.where(ended, 0, low), np.where(ended, index.size, high)
        kept = (stop >= window) & ~(longer & ended)
        active, stop, at, low, high = active[kept], stop[kept], at[kept], low[kept], high[kept]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def repeated_windows(runs: np.ndarray, texts: list[np.ndarray], window: int = WINDOW):
    """The index that ``repeats`` asks for: the windows of each run that occur twice or more."""
    none = np.empty(0, np.int64)
    if not len(texts):
        return none, none, none, none
    data = np.concatenate(texts)
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    units = repeats.word_units(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds), pa.py_buffer(data)))
    _, codes = np.unique(units.values, return_inverse=True)
    codes = codes.astype(np.int64) + 1
    size = np.diff(units.bounds)
    # Runs that stand for several places are in the text a second time.
    twice = np.flatnonzero(runs["several"] > 0)
    which = np.concatenate([np.arange(len(runs)), twice])
    length = size[which] + 1
    begin = np.cumsum(length) - length
    symbols = np.zeros(int(length.sum()), np.int64)
    source = np.repeat(units.bounds[:-1][which] - (np.cumsum(size[which]) - size[which]), size[which])
    filled = np.ones(len(symbols), bool)
    filled[begin + size[which]] = False
    symbols[filled] = codes[source + np.arange(len(source))]
    index = FMIndex(symbols, int(codes.max()) + 1, int(size.max()))
    run, start, stop = matches(index, symbols, begin[: len(runs)], size, window)
    return run, start, stop - window + 1, np.zeros(len(run), np.int64)


def _finish(units: Units, hit: np.ndarray, i: int) -> tuple:
    a, b = units.bounds[i], units.bounds[i + 1]
    removed = hit[a:b]
    n = int(removed.sum())
    if b == a:
        kept = b""
    else:
        begin = units.begins[a]
        words = units.data[begin : units.ends[b - 1]].tobytes()
        if n:
            kept = b" ".join(words[units.begins[j] - begin : units.ends[j] - begin] for j in (a + np.flatnonzero(~removed)).tolist())
        else:
            kept = b" ".join(words.split())
    return b - a, n, hashlib.sha256(kept).hexdigest()


def remove_repeated_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    **dealing: int,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""

    def index(runs, texts):
        return repeated_windows(runs, texts, window)

    shape = Shape(window, gram, repeats.word_units, within=True)
    return repeats.covered(docs, shape, index, _finish, KINDS, id_col, text_col, **dealing)
