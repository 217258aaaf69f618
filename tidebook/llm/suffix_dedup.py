"""Byte strings repeated between documents, removed by suffix arrays of a prefix-free parse.

A byte is removed when a string of 50 bytes that covers it also starts in a
document with a smaller id. ``repeats`` brings all runs of windows that may be
equal into one shard. There the text is parsed: a gram whose rolling hash is zero
modulo ``MODULUS`` is a trigger and ends a phrase, which takes the trigger along, so
that no phrase suffix is the beginning of another. Highly repetitive text has few
distinct phrases. The suffixes of the dictionary are sorted as strings, the
suffixes of the parse as sequences of phrase ranks by doubling; both ranks together
put all window starts into corpus order. Neighbours in that order whose first 50
bytes are equal, compared directly, are occurrences of one string, and the smallest
id among them says from which document on it is a repetition.

Defined cases: a null text is empty; shorter texts than a window keep every byte.
Rows that repeat a doc_id do not remove each other's bytes. A null doc_id counts as
larger than all others. A text is cut into units by one task, with some 46 bytes of
memory per byte of it, so one of 60 MB needs more than a 3,000 MB executor. An empty
table gives an empty result. Other columns are not carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from tidebook.llm import repeats
from tidebook.llm.repeats import Rolling, Shape, Units

WINDOW = 50
GRAM = 24
TRIGGER = 8
MODULUS = 16
BLOCK_ROWS = 50_000
KINDS = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]


def _rows(text: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes from each start on, zeros beyond the text."""
    padded = np.concatenate([text, np.zeros(width, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, width)[start]


def _strings(text: np.ndarray, start: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """The stretches as fixed-width strings, the last byte their length, so that order and equality are exact."""
    rows = np.zeros((len(start), width + 1), np.uint8)
    rows[:, :width] = _rows(text, start, width)
    rows[:, width] = np.minimum(stop - start, 255)
    rows[:, :width][np.arange(width, dtype=np.uint8) >= rows[:, width:]] = 0
    return rows.view(f"S{width + 1}").ravel()


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of rows of keys, the first key foremost; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), np.int64)
    for key in keys:
        sorted_ = key[order]
        fresh[1:] |= sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh) + 1
    return rank


def corpus_order(text: np.ndarray, bounds: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """Window starts (given in order) in the order of the suffixes that begin there."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    grams = Rolling(text).grams(TRIGGER)
    cut = np.zeros(len(text), bool)
    cut[: len(grams)] = (grams % np.uint64(MODULUS) == 0) & (np.arange(len(grams)) + TRIGGER <= ends[: len(grams)])
    cut[bounds[:-1]] = True
    begin = np.flatnonzero(cut)
    same = np.append(ends[begin][1:] == ends[begin][:-1], False)
    after = np.append(begin[1:], len(text))
    stop = np.where(same, np.minimum(after + TRIGGER, ends[begin]), ends[begin])

    # The parse: ranks of phrases, then of the parse's suffixes as far as a window reaches.
    content = Rolling(text).stretches(begin, stop)
    rank = _dense(_strings(text, begin, np.minimum(stop, begin + window), window), content)
    step = 1
    while step < window and len(rank):
        following = np.zeros(len(rank), np.int64)
        following[:-step] = np.where(ends[begin][step:] == ends[begin][:-step], rank[step:], 0)
        rank = _dense(rank, following)
        step *= 2

    # The dictionary: each distinct phrase suffix in which a window starts.
    phrase = np.searchsorted(begin, windows, "right") - 1
    number = _dense(content)[phrase]
    offset = windows - begin[phrase]
    _, first, which = np.unique(number * (offset.max(initial=0) + 1) + offset, return_index=True, return_inverse=True)
    suffix = _strings(text, windows[first], np.minimum(stop[phrase[first]], windows[first] + window), window)
    suffix_rank = _dense(suffix)[which]
    following = np.where(same[phrase], rank[np.minimum(phrase + 1, len(rank) - 1)], 0)
    following[stop[phrase] - windows >= window] = 0
    return np.lexsort((following, suffix_rank))


def first_ids(runs: np.ndarray, texts: list[np.ndarray], window: int = WINDOW):
    """The index that ``repeats`` asks for: the smallest id of each window's string."""
    none = np.empty(0, np.int64)
    if not len(texts):
        return none, none, none, none
    text = np.concatenate(texts)
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    count = runs["windows"].astype(np.int64)
    first = np.cumsum(count) - count
    run = np.repeat(np.arange(len(runs)), count)
    windows = np.repeat(bounds[:-1] - first, count) + np.arange(count.sum())
    order = corpus_order(text, bounds, windows, window)
    fresh = np.ones(len(order), bool)
    for a in range(0, len(order) - 1, BLOCK_ROWS):
        rows = _rows(text, windows[order[a : a + BLOCK_ROWS + 1]], window)
        fresh[a + 1 : a + len(rows)] = (rows[1:] != rows[:-1]).any(axis=1)
    start = np.flatnonzero(fresh)
    own = runs["id"][run].astype(np.int64)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(own[order], start), np.diff(np.append(start, len(order))))
    useful = (least < own) | (runs["several"][run] > 0)
    turn = np.ones(len(run), bool)
    turn[1:] = (run[1:] != run[:-1]) | (least[1:] != least[:-1]) | (useful[1:] != useful[:-1])
    low = np.flatnonzero(turn)
    high = np.append(low[1:], len(run))
    kept = useful[low]
    low, high = low[kept], high[kept]
    return run[low], low - first[run[low]], high - first[run[low]], least[low]


def _finish(units: Units, hit: np.ndarray, i: int) -> tuple:
    a, b = units.bounds[i], units.bounds[i + 1]
    data, removed = units.data[a:b], hit[a:b]
    spans = int(removed[:1].sum()) + int((removed[1:] & ~removed[:-1]).sum())
    kept = data[~removed] if spans else data
    return b - a, int(removed.sum()), spans, hashlib.sha256(kept.tobytes()).hexdigest()


def _shape(window: int, gram: int) -> Shape:
    return Shape(window, gram, repeats.byte_units, within=False)


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    **dealing: int,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""

    def index(runs, texts):
        return first_ids(runs, texts, window)

    return repeats.covered(docs, _shape(window, gram), index, _finish, KINDS, id_col, text_col, **dealing)
