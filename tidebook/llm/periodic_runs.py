"""Periodic runs of words, by recursive frequency splitting and a scan of lags.

A run is a stretch of words with smallest period q, of at least four periods and
six words, that no neighbouring word extends keeping that period.

1. **Splitting.** Each word of a run occurs in it at least four times. A word that
   its segment has less often is in no run, so it splits the segment; the parts are
   counted anew, as a word may be too rare in a part though not in the whole, until
   no segment changes. Parts of fewer than six words are dropped. All segments of a
   slice of texts are counted together; those that did not change are not counted
   again. Splitting never divides a run, so the scan is exact on whatever segments
   it is given, and ``ROUNDS`` bounds the work on texts made to split word by word.
2. **Lag scan.** In what survives, every position has a lag: the distance to the
   next occurrence of its window of L words, L = 1, 2, 4, ... Two equal windows with a
   lag q of at most L overlap in a stretch of period q, and by the periodicity lemma
   no nearer window is equal inside a run of that period. So a run of period q, for
   L/2 < q <= L, is exactly a stretch of positions of constant lag q, and its length
   is the stretch's plus L + q - 1. Windows are told apart by exact ranks, doubled from
   the ranks of their halves; positions without an equal window leave the scan.

Work is n log n in a text's words. A text is handled in one task with some 20 bytes
per byte of text; nothing is shuffled, so copies and hot sources cost only themselves.

Defined cases: a null or empty text, and one of white space, has no words, no runs and
the digests of the empty string. A null id is never repeated (see ``cycle_seed``). Rows
that repeat are judged alike. Texts may be of any length. Ties of the strongest run go
to the smallest start, then the smallest period. An empty table gives an empty result.
Columns of the input stay, except ``runs``, which is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import common

REPEATS, LEAST_WORDS = 4, 6
ROUNDS = 64
FOUND = (
    "struct<n_words:long,spans:array<struct<start:long,length:long,period:long>>,"
    "strongest:struct<start:long,length:long,period:long,exponent_milli:long>,"
    "runs_sha256:string,collapsed_sha256:string,collapsed:string>"
)


def surviving(codes: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that can be in a run, and numbers that tell their segments apart.

    ``segment`` holds the segment number of each code; a segment is a stretch of places.
    """
    place = np.arange(len(codes))
    done = []
    for _ in range(ROUNDS):
        if not len(place):
            break
        order = np.lexsort((codes[place], segment))
        c, s = codes[place][order], segment[order]
        first = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])]))
        count = np.empty(len(place), np.int64)
        count[order] = np.repeat(np.diff(np.append(first, len(c))), np.diff(np.append(first, len(c))))
        often = count >= REPEATS
        # Segments of which no word is too rare are stable.
        changed = np.zeros(int(segment.max()) + 1, bool)
        changed[segment[~often]] = True
        stable = ~changed[segment]
        done.append((place[stable], segment[stable]))
        left = often & ~stable
        parent = segment[left]
        place = place[left]
        place, segment = _parts(place, parent)
    done.append((place, segment))
    where = np.concatenate([p for p, _ in done])
    # A segment is known by its first place.
    heads = np.concatenate([_heads(p, s) for p, s in done])
    order = np.argsort(where, kind="stable")
    return where[order], heads[order]


def _starts(place: np.ndarray, segment: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(segment) != 0)])) if len(place) else place


def _heads(place: np.ndarray, segment: np.ndarray) -> np.ndarray:
    at = _starts(place, segment)
    return np.repeat(place[at], np.diff(np.append(at, len(place))))


def _parts(place: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring places of one parent form a part; short parts are dropped."""
    at = _starts(place, parent)
    size = np.diff(np.append(at, len(place)))
    long_enough = np.repeat(size >= LEAST_WORDS, size)
    number = np.repeat(np.arange(len(at)), size)[long_enough]
    return place[long_enough], np.unique(number, return_inverse=True)[1] if len(number) else number


def runs_of(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start, length and period of all runs of texts laid end to end, by start, then period."""
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place, head = surviving(codes, texts)
    found = [np.empty((0, 3), np.int64)]
    if len(place):
        at = np.flatnonzero(np.concatenate([[True], np.diff(head) != 0]))
        size = np.diff(np.append(at, len(place)))
        end = np.repeat(at + size, size)  # of each place's segment, in the scan's own numbers
        found.append(_scan(np.unique(codes[place], return_inverse=True)[1], end, int(size.max())))
    runs = np.concatenate(found)
    if len(runs):
        runs[:, 0] = place[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _scan(rank: np.ndarray, end: np.ndarray, longest: int) -> np.ndarray:
    """Runs in segments laid end to end; ``end`` is where each position's segment ends."""
    n, out = len(rank), []
    live = np.arange(n)  # positions whose window has an equal one in its segment's slice
    window = 1
    rank = rank.astype(np.int64)
    while True:
        order = live[np.argsort(rank[live], kind="stable")]
        same = (rank[order[1:]] == rank[order[:-1]]) & (end[order[1:]] == end[order[:-1]])
        lag = np.zeros(n, np.int64)
        lag[order[:-1][same]] = (order[1:] - order[:-1])[same]
        fits = np.flatnonzero((lag > window // 2) & (lag <= window))
        if len(fits):
            q = lag[fits]
            first = np.concatenate([[True], (np.diff(fits) != 1) | (np.diff(q) != 0) | (np.diff(end[fits]) != 0)])
            at = np.flatnonzero(first)
            size, period = np.diff(np.append(at, len(fits))), q[at]
            length = size + window + period - 1
            good = length >= np.maximum(LEAST_WORDS, REPEATS * period)
            out.append(np.stack([fits[at], length, period], axis=1)[good])
        if REPEATS * (window + 1) > longest:
            break
        paired = np.zeros(n, bool)
        paired[order[1:][same]] = True
        paired[order[:-1][same]] = True
        # A window twice as long is equal to another only if both of its halves are.
        live = np.flatnonzero(paired)
        live = live[live + 2 * window <= end[live]]
        live = live[paired[live + window]]
        if not len(live):
            break
        both = np.stack([rank[live], rank[live + window]])
        order = np.lexsort((both[1], both[0]))
        step = np.concatenate([[0], np.any(np.diff(both[:, order], axis=1) != 0, axis=0)])
        longer = np.full(n, -1, np.int64)
        longer[live[order]] = np.cumsum(step)
        rank, window = longer, 2 * window
    return np.concatenate(out) if out else np.empty((0, 3), np.int64)


def cycle_seed(id_col: str) -> Column:
    """From where a document's words repeat and how, by the CRC of its id; null where they do not."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.when(h % 10 == 0, F.floor(h / 10).cast("long"))


def _repeated(codes: np.ndarray, bounds: np.ndarray, seeds: list[int | None]) -> None:
    """Words from a place on become a cycle of the first ones there."""
    for i, g in enumerate(seeds):
        n = int(bounds[i + 1] - bounds[i])
        if g is not None and n:
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            start = int(bounds[i]) + a
            codes[start : bounds[i + 1]] = codes[start + np.arange(n - a) % period]


def _results(texts: pa.Array, seeds: list[int | None], with_text: bool) -> Iterator[dict]:
    codes, bounds, words = common.split_words(texts)
    codes = codes.copy()
    _repeated(codes, bounds, seeds)
    runs = runs_of(codes, bounds)
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(gone[:-1]) == 0
    owner = np.searchsorted(runs[:, 0], bounds)
    for i in range(len(bounds) - 1):
        own = runs[owner[i] : owner[i + 1]]
        own = (own - [bounds[i], 0, 0]).tolist()
        left = slice(bounds[i], bounds[i + 1])
        rest = " ".join(words.take(pa.array(codes[left][kept[left]])).to_pylist())
        strongest = None
        if own:
            start, length, period = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
            strongest = {"start": start, "length": length, "period": period, "exponent_milli": 1000 * length // period}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        yield {
            "n_words": int(bounds[i + 1] - bounds[i]),
            "spans": [{"start": s, "length": n, "period": q} for s, n, q in own],
            "strongest": strongest,
            "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(rest.encode()).hexdigest(),
            "collapsed": rest if with_text else None,
        }


def find_runs(docs: DataFrame, text_col: str = "text", seed: Column | None = None, with_text: bool = False) -> DataFrame:
    """The rows with ``runs``: all runs, the strongest, and digests of both and of the words kept.

    ``seed`` says per row how its words repeat before they are scanned; null: not at all.
    A word is kept unless some run has it after its first period. ``with_text`` also
    returns the kept words, joined by one blank.
    """
    common.ship(docs.sparkSession)

    @F.arrow_udf(FOUND)
    def scan(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = None
        for text, seeds in texts:
            done, parts = 0, []
            for part in common.slices(text):
                rows = list(_results(part, seeds.slice(done, len(part)).to_pylist(), with_text))
                done += len(part)
                kind = kind or _arrow_type()
                parts.append(pa.array(rows, kind))
            yield pa.concat_arrays(parts) if parts else pa.array([], _arrow_type())
            pa.default_memory_pool().release_unused()

    seed = F.lit(None) if seed is None else seed
    return docs.withColumn("runs", scan(F.col(text_col).cast("string"), seed.cast("long")))


def _arrow_type() -> pa.DataType:
    run = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
    return pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct(run))),
            ("strongest", pa.struct([*run, ("exponent_milli", pa.int64())])),
            ("runs_sha256", pa.string()),
            ("collapsed_sha256", pa.string()),
            ("collapsed", pa.string()),
        ]
    )
