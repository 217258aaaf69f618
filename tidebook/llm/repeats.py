"""Repeated windows between documents: sampling, dealing, and taking results back.

Two operators look for windows of a fixed number of units (bytes, or words) that
occur more than once in a corpus. All of a corpus's windows are too many to
shuffle, so both do this, with an index of their own in step 3:

1. Documents are dealt to chunks of bounded size. Of all grams in a window the one
   with the smallest rolling hash is its key; equal windows have equal keys, and
   consecutive windows mostly share theirs. A chunk sends each key once.
2. Keys that occur once in the corpus are done. The others go back to their chunks.
3. A chunk cuts out the runs of windows with a repeated key and sends the hash of
   each distinct run once to the shard of its key. All windows that are equal to one
   in a run are in the same shard. Runs that are the same in all places need no
   index. Of the others the shard asks one chunk each for the text, indexes them, and
   answers for each run which windows occur elsewhere.
4. The chunk takes the answers to its documents.

Keys that are in very many chunks are hot. Their windows are sent one by one and
dealt by the whole window's hash, so that the texts around one common passage do
not meet in one shard. Every step reads the same shuffled documents, and what is
sent is packed into one row per sender and receiver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import common

CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
HOT_CHUNKS = 1_000
LAST_ID = np.iinfo(np.int64).max
KEY_BITS = np.uint64((1 << 47) - 1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

PACKED = "receiver long, chunk long, packed binary"
TEXTS = "receiver long, chunk long, packed binary, bytes binary"
#: A run as sent to a shard; ``id`` is the smallest document id, ``several`` whether it stands for more than one place.
RUN = np.dtype([("key", "<u8"), ("content", "<u8"), ("id", "<i8"), ("windows", "<i4"), ("several", "u1")])
#: What a chunk is asked for, and what it sends.
WANTED = np.dtype([("content", "<u8")])
TEXT = np.dtype([("content", "<u8"), ("size", "<i4")])
#: Who sent a row to a chunk.
FROM_KEYS, FROM_INDEX, FROM_WANTED = -1, -2, -3
#: Windows ``low`` to ``high`` of a run occur elsewhere, first in document ``id``.
ANSWER = np.dtype([("content", "<u8"), ("low", "<i4"), ("high", "<i4"), ("id", "<i8")])

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Rolling polynomial hashes of any stretch of a sequence of units."""

    def __init__(self, units: np.ndarray):
        up, self.down = powers(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[: len(units)], out=self.sums[1:])

    def grams(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return common.mixed((self.sums[width:] - self.sums[:n]) * self.down[:n])

    def stretches(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the units from start to stop, lengths mixed in."""
        plain = (self.sums[stop] - self.sums[start]) * self.down[start]
        return common.mixed(plain ^ common.mixed((stop - start).astype(np.uint64)))


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


@dataclass
class Units:
    """A slice of texts as units, and where unit i begins and ends among the bytes."""

    data: np.ndarray
    values: np.ndarray
    bounds: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def byte_units(texts: pa.Array) -> Units:
    data, bounds = common.bytes_of(texts)
    place = np.arange(len(data) + 1)
    return Units(data, data, bounds, place[:-1], place[1:])


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_units(texts: pa.Array) -> Units:
    """Words between white space; a unit's value is its bytes' hash."""
    data, bounds = common.bytes_of(texts)
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = BLANK[data]
    starts_word = blank[:-1] & ~blank[1:]
    starts_word[bounds[bounds < len(data)]] = ~blank[1:][bounds[bounds < len(data)]]
    ends_word = ~blank[:-1] & blank[1:]
    ends_word[bounds] |= ~blank[:-1][bounds]
    begins, ends = np.flatnonzero(starts_word), np.flatnonzero(ends_word)
    values = Rolling(data).stretches(begins, ends)
    return Units(data, values, np.searchsorted(begins, bounds), begins, ends)


@dataclass
class Runs:
    """Runs of windows with one key: first window, number of windows, key, and the text."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    text: np.ndarray
    rolling: Rolling

    def of(self, chosen: np.ndarray) -> Runs:
        return Runs(self.start[chosen], self.count[chosen], self.key[chosen], self.text[chosen], self.rolling)

    def contents(self, window: int) -> np.ndarray:
        return self.rolling.stretches(self.start, self.start + self.count + (window - 1))

    def single(self, window: int) -> Runs:
        """Every window as a run of its own, keyed by its whole content."""
        first = np.cumsum(self.count) - self.count
        start = np.repeat(self.start - first, self.count) + np.arange(self.count.sum())
        key = self.rolling.stretches(start, start + window) & KEY_BITS
        return Runs(start, np.ones(len(start), np.int64), key, np.repeat(self.text, self.count), self.rolling)


@dataclass(frozen=True)
class Shape:
    """Windows of ``window`` units, keyed by the smallest hash of their grams."""

    window: int
    gram: int
    units: Callable[[pa.Array], Units]
    #: whether a window can repeat within its own document
    within: bool

    def runs(self, units: Units) -> Runs:
        n, rolling = len(units.values), Rolling(units.values)
        none = np.empty(0, np.int64)
        if n < self.window:
            return Runs(none, none, none.astype(np.uint64), none, rolling)
        least = sliding(rolling.grams(self.gram), self.window - self.gram + 1, np.minimum)
        inside = self._inside(units, len(least))
        turn = np.ones(len(least), bool)
        turn[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
        # A window that starts a document follows one that crosses into it, if windows are longer than a unit.
        turns = np.flatnonzero(turn)
        count = np.diff(np.append(turns, len(least)))
        kept = inside[turns]
        start, count = turns[kept], count[kept]
        text = np.searchsorted(units.bounds, start, "right") - 1
        return Runs(start, count, least[start] & KEY_BITS, text, rolling)

    def anchors(self, units: Units) -> np.ndarray:
        """Keys of all grams that are the smallest of some window, each as often as it is there."""
        grams = Rolling(units.values).grams(self.gram)
        width = self.window - self.gram + 1
        if len(grams) < width:
            return np.empty(0, np.uint64)
        least = np.where(self._inside(units, len(grams) - width + 1), sliding(grams, width, np.minimum), np.uint64(0))
        around = np.zeros(len(grams) + width - 1, np.uint64)
        around[width - 1 : width - 1 + len(least)] = least
        return grams[sliding(around, width, np.maximum) == grams] & KEY_BITS

    def _inside(self, units: Units, n: int) -> np.ndarray:
        """Whether each of n windows ends in the document where it begins."""
        edge = np.zeros(len(units.values) + 1, np.int64)
        lows = np.maximum(units.bounds[:-1], units.bounds[1:] - self.window + 1)
        np.add.at(edge, lows, 1)
        np.add.at(edge, units.bounds[1:], -1)
        return np.cumsum(edge)[:n] == 0


def _pack(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _dealt(receiver: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each receiver and the places that go to it."""
    order = np.argsort(receiver, kind="stable")
    dealt = receiver[order]
    cuts = np.append(np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])), len(dealt)) if len(dealt) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(dealt[a]), order[a:b]


def _ids(table: pa.Table) -> np.ndarray:
    """Document ids; a null one comes after all others."""
    return table.column("id").fill_null(LAST_ID).to_numpy()


def parts_of(table: pa.Table, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """The table's texts in slices, with the number of the first."""
    done = 0
    for text in table.column("text").chunks:
        for part in common.slices(text, limit):
            yield done, part
            done += len(part)


def _keys_of(shape: Shape, receivers: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        found, owners = [], []
        for first, part in parts_of(docs):
            units = shape.units(part)
            if shape.within:
                found.append(shape.anchors(units))
            else:
                runs = shape.runs(units)
                found.append(runs.key)
                owners.append(runs.text + first)
        keys = np.concatenate(found)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        if shape.within:
            several = np.diff(np.append(start, len(keys))) > 1
        elif len(start):
            owner = np.concatenate(owners)[order]
            several = np.maximum.reduceat(owner, start) != np.minimum.reduceat(owner, start)
        else:
            several = np.empty(0, bool)
        keys = keys[start]
        sent = keys << np.uint64(1) | several.astype(np.uint64)
        rows = [(r, _pack(sent[at]).tobytes()) for r, at in _dealt((keys % np.uint64(receivers)).astype(np.int64))]
        return pa.table(
            {
                "receiver": pa.array([r for r, _ in rows], pa.int64()),
                "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                "packed": pa.array([p for _, p in rows], pa.binary()),
            }
        )

    return run


def _repeated(hot: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpack(p) for p in table.column("packed").to_pylist()]
        chunks = table.column("chunk").to_numpy()
        sender = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        sent = np.concatenate(parts)
        keys, several = sent >> np.uint64(1), sent & np.uint64(1)
        order = np.argsort(keys, kind="stable")
        keys, several, sender = keys[order], several[order], sender[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        more = (size > 1) | (np.maximum.reduceat(several, start) > 0)
        kept = np.repeat(more, size)
        back = keys << np.uint64(1) | np.repeat(size >= hot, size).astype(np.uint64)
        back, sender = back[kept], sender[kept]
        rows = [(int(chunks[s]), _pack(back[at]).tobytes()) for s, at in _dealt(sender)]
        return pa.table(
            {
                "receiver": pa.array([c for c, _ in rows], pa.int64()),
                "chunk": pa.array([FROM_KEYS] * len(rows), pa.int64()),
                "packed": pa.array([p for _, p in rows], pa.binary()),
            }
        )

    return run


class Repeated:
    """A chunk's repeated keys, with the hot ones among them."""

    def __init__(self, packed: list[bytes]):
        sent = np.concatenate([_unpack(p) for p in packed]) if packed else np.empty(0, np.uint64)
        sent = np.sort(sent)
        self.keys, self.hot = sent >> np.uint64(1), (sent & np.uint64(1)) > 0

    def runs(self, shape: Shape, units: Units) -> Runs:
        """The runs of windows with a repeated key; windows of a hot key one by one."""
        runs = shape.runs(units)
        if not len(self.keys):
            return runs.of(np.zeros(len(runs.key), bool))
        at = np.minimum(np.searchsorted(self.keys, runs.key), len(self.keys) - 1)
        there = self.keys[at] == runs.key
        hot = there & self.hot[at]
        if not hot.any():
            return runs.of(there)
        plain, single = runs.of(there & ~hot), runs.of(hot).single(shape.window)
        joined = (np.concatenate([getattr(plain, n), getattr(single, n)]) for n in ("start", "count", "key", "text"))
        return Runs(*joined, runs.rolling)


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return data[place]


def _rows_to(rows: list[tuple[int, bytes]], chunk: int) -> pa.Table:
    return pa.table(
        {
            "receiver": pa.array([r for r, _ in rows], pa.int64()),
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "packed": pa.array([p for _, p in rows], pa.binary()),
        }
    )


def _packed_from(sent: pa.Table, sender: int) -> list[bytes]:
    chunk = sent.column("chunk").to_numpy()
    return [p for p, c in zip(sent.column("packed").to_pylist(), chunk) if c == sender]


def _receivers(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    return _dealt((keys % np.uint64(n)).astype(np.int64))


def _heads_of(shape: Shape, receivers: int):
    """What a chunk tells the shards about its runs, without their text."""

    def run(key: tuple, docs: pa.Table, sent: pa.Table) -> pa.Table:
        repeated, ids = Repeated(sent.column("packed").to_pylist()), _ids(docs)
        heads = [np.empty(0, RUN)]
        for first, part in parts_of(docs) if len(repeated.keys) else ():
            runs = repeated.runs(shape, shape.units(part))
            head = np.zeros(len(runs.start), RUN)
            head["key"], head["content"] = runs.key, runs.contents(shape.window)
            head["id"], head["windows"] = ids[runs.text + first], runs.count
            heads.append(_distinct(head)[0])
        head = _distinct(np.concatenate(heads))[0]
        rows = [(r, _by_column(head[at])) for r, at in _receivers(head["key"], receivers)]
        return _rows_to(rows, key[0].as_py())

    return run


def _texts_of(shape: Shape, receivers: int):
    """The text of the runs that shards ask this chunk for."""

    def run(key: tuple, docs: pa.Table, sent: pa.Table) -> pa.Table:
        wanted = [_from_columns(p, WANTED) for p in _packed_from(sent, FROM_WANTED)]
        asked = np.sort(np.concatenate(wanted)["content"]) if wanted else np.empty(0, np.uint64)
        repeated = Repeated(_packed_from(sent, FROM_KEYS) if len(asked) else [])
        open_ = np.ones(len(asked), bool)
        rows = []
        for _, part in parts_of(docs) if len(asked) else ():
            units = shape.units(part)
            runs = repeated.runs(shape, units)
            contents = runs.contents(shape.window)
            at = np.minimum(np.searchsorted(asked, contents), len(asked) - 1)
            there = np.flatnonzero((asked[at] == contents) & open_[at])
            there = there[np.unique(at[there], return_index=True)[1]]
            open_[at[there]] = False
            begin = units.begins[runs.start[there]]
            text = np.zeros(len(there), TEXT)
            text["content"] = contents[there]
            text["size"] = units.ends[runs.start[there] + runs.count[there] + shape.window - 2] - begin
            for r, own in _receivers(runs.key[there], receivers):
                body = _gathered(units.data, begin[own], text["size"][own].astype(np.int64))
                rows.append((r, _by_column(text[own]), squeezed(body.tobytes())))
        columns = list(zip(*_joined(rows))) or [(), (), ()]
        return pa.table(
            {
                "receiver": pa.array(columns[0], pa.int64()),
                "chunk": pa.array([key[0].as_py()] * len(columns[0]), pa.int64()),
                "packed": pa.array(columns[1], pa.binary()),
                "bytes": pa.array(columns[2], pa.binary()),
            }
        )

    return run


def _joined(rows: list[tuple[int, bytes, bytes]]) -> list[tuple[int, bytes, bytes]]:
    """One row per receiver."""
    by: dict[int, list] = {}
    for r, text, body in rows:
        by.setdefault(r, []).append((text, body))
    out = []
    for r, parts in by.items():
        text = np.concatenate([_from_columns(t, TEXT) for t, _ in parts])
        out.append((r, _by_column(text), squeezed(b"".join(unsqueezed(b) for _, b in parts))))
    return out


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return data[place]


def squeezed(data: bytes) -> bytes:
    """Compressed for the way to another task; its length comes first."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _by_column(head: np.ndarray) -> bytes:
    return squeezed(b"".join(head[name].tobytes() for name in head.dtype.names))


def _from_columns(data: bytes, kind: np.dtype) -> np.ndarray:
    data, at = unsqueezed(data), 0
    out = np.empty(len(data) // kind.itemsize, kind)
    for name in kind.names:
        size = len(out) * kind[name].itemsize
        out[name] = np.frombuffer(data[at : at + size], kind[name])
        at += size
    return out


def _distinct(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry per key and content, and which of the given ones it is."""
    order = np.lexsort((head["id"], head["content"], head["key"]))
    head = head[order]
    fresh = np.ones(len(head), bool)
    fresh[1:] = (head["content"][1:] != head["content"][:-1]) | (head["key"][1:] != head["key"][:-1])
    start = np.flatnonzero(fresh)
    out = head[start].copy()
    out["several"] = (np.diff(np.append(start, len(head))) > 1) | (np.maximum.reduceat(head["several"], start) > 0)
    return out, order[start]


def _heads(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs that a shard was told of, which row each came with, and the rows' chunks."""
    parts = [_from_columns(p.as_py(), RUN) for p in table.column("packed")]
    sender = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return np.concatenate(parts or [np.empty(0, RUN)]), sender, table.column("chunk").to_numpy()


def _for_index(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which distinct runs need the index, and which are answered by their number alone.

    Keys with one content have nothing else to be compared with, but a single run
    of several windows may repeat within itself.
    """
    many = np.zeros(len(runs), bool)
    same = runs["key"][1:] == runs["key"][:-1]
    many[1:] |= same
    many[:-1] |= same
    inside = np.flatnonzero(many | (runs["windows"] > 1) & (runs["several"] == 0))
    return inside, np.flatnonzero(~many & (runs["several"] > 0))


def _wanted(key: tuple, table: pa.Table) -> pa.Table:
    """Each run that needs the index is asked of one of the chunks that have it."""
    sent, sender, chunks = _heads(table)
    runs, pick = _distinct(sent)
    inside, _ = _for_index(runs)
    asked = np.zeros(len(inside), WANTED)
    asked["content"] = runs["content"][inside]
    rows = [(int(chunks[s]), _by_column(asked[at])) for s, at in _dealt(sender[pick[inside]])]
    return _rows_to(rows, FROM_WANTED)


#: What an index answers: for each distinct run the windows that occur elsewhere, as
#: arrays (run, low, high, id).
Index = Callable[[np.ndarray, list[np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _answers(index: Index):
    def run(key: tuple, table: pa.Table, texts: pa.Table) -> pa.Table:
        sent, sender, chunks = _heads(table)
        runs, _ = _distinct(sent)
        inside, alone = _for_index(runs)
        held = {}
        for packed, body in zip(texts.column("packed"), texts.column("bytes")):
            text, body = _from_columns(packed.as_py(), TEXT), np.frombuffer(unsqueezed(body.as_py()), np.uint8)
            ends = np.cumsum(text["size"], dtype=np.int64)
            for content, size, end in zip(text["content"].tolist(), text["size"].tolist(), ends.tolist()):
                held[content] = body[end - size : end]
        found, low, high, ids = index(runs[inside], [held[c] for c in runs["content"][inside].tolist()])
        answer = np.zeros(len(alone) + len(found), ANSWER)
        which = np.concatenate([alone, inside[found]]).astype(np.int64)
        answer["content"] = runs["content"][which]
        answer["low"] = np.concatenate([np.zeros(len(alone), np.int64), low])
        answer["high"] = np.concatenate([runs["windows"][alone], high])
        answer["id"] = np.concatenate([runs["id"][alone], ids])
        # Every sender of a run gets the run's answers.
        answer = answer[np.argsort(which, kind="stable")]
        which = np.sort(which)
        place = np.full(len(sent), -1)
        order = np.lexsort((sent["id"], sent["content"], sent["key"]))
        fresh = np.zeros(len(sent), np.int64)
        fresh[1:] = (sent["content"][order][1:] != sent["content"][order][:-1]) | (sent["key"][order][1:] != sent["key"][order][:-1])
        place[order] = np.cumsum(fresh)
        first, last = np.searchsorted(which, place), np.searchsorted(which, place, "right")
        n = last - first
        taken = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        back = answer[taken]
        rows = [(int(chunks[s]), _by_column(back[at])) for s, at in _dealt(np.repeat(sender, n))]
        return _rows_to(rows, FROM_INDEX)

    return run


class Answers:
    """What the shards answered a chunk."""

    def __init__(self, packed: list[bytes]):
        found = np.concatenate([_from_columns(p, ANSWER) for p in packed]) if packed else np.empty(0, ANSWER)
        self.found = found[np.argsort(found["content"], kind="stable")]

    def windows(self, runs: Runs, contents: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, first window, end of windows, id) of all answered stretches of the runs."""
        first = np.searchsorted(self.found["content"], contents)
        last = np.searchsorted(self.found["content"], contents, "right")
        n = last - first
        own = np.repeat(np.arange(len(n)), n)
        got = self.found[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return runs.text[own], runs.start[own] + got["low"], runs.start[own] + got["high"], got["id"]


def covered(
    docs: DataFrame,
    shape: Shape,
    index: Index,
    finish: Callable[[Units, np.ndarray, int], tuple],
    kinds: list[tuple[str, str]],
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    hot: int = HOT_CHUNKS,
) -> DataFrame:
    """One row per document: its id, and what ``finish`` makes of its units and a mask of those covered."""
    common.ship(docs.sparkSession)
    docs = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // chunk_bytes))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(n))).groupBy("chunk")
    keys = docs.applyInArrow(_keys_of(shape, n), PACKED)
    repeated = keys.groupBy("receiver").applyInArrow(_repeated(hot), PACKED)
    back = repeated.groupBy("receiver")
    heads = docs.cogroup(back).applyInArrow(_heads_of(shape, n), PACKED).groupBy("receiver")
    wanted = heads.applyInArrow(_wanted, PACKED)
    texts = docs.cogroup(repeated.unionByName(wanted).groupBy("receiver")).applyInArrow(_texts_of(shape, n), TEXTS)
    answers = heads.cogroup(texts.groupBy("receiver")).applyInArrow(_answers(index), PACKED)
    back = repeated.unionByName(answers).groupBy("receiver")

    def apply(key: tuple, table: pa.Table, sent: pa.Table) -> pa.Table:
        repeated, known = Repeated(_packed_from(sent, FROM_KEYS)), Answers(_packed_from(sent, FROM_INDEX))
        ids, rows = _ids(table), []
        for first, part in parts_of(table):
            units = shape.units(part)
            edge = np.zeros(len(units.values) + 1, np.int64)
            if len(known.found):
                runs = repeated.runs(shape, units)
                text, low, high, holder = known.windows(runs, runs.contents(shape.window))
                if not shape.within:
                    earlier = holder < ids[text + first]
                    low, high = low[earlier], high[earlier]
                np.add.at(edge, low, 1)
                np.add.at(edge, high + (shape.window - 1), -1)
            hit = np.cumsum(edge)[:-1] > 0
            rows += [finish(units, hit, i) for i in range(len(part))]
        columns = list(zip(*rows))
        return pa.table(
            [table.column("id"), *(pa.array(c, ARROW[k]) for c, (_, k) in zip(columns, kinds))],
            names=["doc_id", *(name for name, _ in kinds)],
        )

    schema = ", ".join(["doc_id long", *(f"{name} {kind}" for name, kind in kinds)])
    return docs.cogroup(back).applyInArrow(apply, schema)


ARROW = {"long": pa.int64(), "string": pa.string()}
