"""Benchmark passages in documents, by Wu-Manber multi-pattern search over words.

Patterns are the windows of ten consecutive words of each benchmark item; an item
of fewer words is one pattern. Patterns of one length m are searched together: a
shift table by blocks of two words says how far the end of the search window can
move without passing an occurrence (m - 1 words for a block that no pattern has),
blocks that end a pattern lead to the bucket of patterns with that end, and a
direct comparison of all m words confirms.

Spark cuts the items into stretches of at most ``STRETCH`` words that overlap by a window
less one, writes them as a table, and deals it to blocks of about ``BLOCK_BYTES``. A
block travels as Arrow bytes with the function that searches it; each task builds the
block's tables from them, words as numbers. With one block the documents are read once
and nothing is written or shuffled. With several, documents are written once with a
row number, each block's hits are written before the next block is taken, and the
hits, one row per document that has any, are joined back by that number. Driver and
workers hold one block at a time, however large the benchmark.

Defined cases: a null text has no words. An item without words has no pattern.
A null item id: its words are hit, and the item is not listed. Items of equal
text are all listed; items with equal ids once. Rows that repeat are judged alike.
With an empty benchmark nothing is hit. Texts and items may be of any length: those
of a batch are searched in slices, a long text alone, with some 30 bytes per byte.
Columns of the input stay, except ``words``, ``hits`` and ``items``, which are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import common

WINDOW = 10
BLOCK_BYTES = 4 << 20
STRETCH = 4_096
SEARCHED = "struct<n_words:long,spans:array<struct<start:long,stop:long>>,items:array<string>>"

# Words are runs of 0-9, a-z after lower-casing A-Z, and all that is not ASCII.
WORD_MAP = common.ascii_lower()
WORD_MAP[[b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]] = 32


class Search:
    """Shift tables and buckets for a block of items, words as numbers from 1.

    ``items`` has a row per stretch: the item's id as text, and its words.
    """

    def __init__(self, items: pa.Table, window: int = WINDOW):
        lists = items.column("words").combine_chunks()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        codes = coded.indices.to_numpy().astype(np.int64) + 1
        self.vocabulary = {w: i + 1 for i, w in enumerate(coded.dictionary.to_pylist())}
        self.base = len(self.vocabulary) + 1
        owners = items.column("item").combine_chunks().dictionary_encode()
        self.items = owners.dictionary.to_pylist()
        owner = owners.indices.fill_null(-1).to_numpy().astype(np.int64)
        size = np.diff(bounds)
        length = np.minimum(size, window)
        self.groups = []
        for m in np.unique(length[length > 0]).tolist():
            own = np.flatnonzero(length == m)
            many = size[own] - m + 1
            first = np.repeat(bounds[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            patterns, which = np.unique(codes[first[:, None] + np.arange(m)], axis=0, return_inverse=True)
            self.groups.append(self._tables(m, patterns, which.ravel(), np.repeat(owner[own], many)))

    def _blocks(self, patterns: np.ndarray, end: int) -> np.ndarray:
        """The block of one or two words before ``end`` as a number."""
        if patterns.shape[1] == 1:
            return patterns[:, 0]
        return patterns[:, end - 2] * self.base + patterns[:, end - 1]

    def _tables(self, m: int, patterns: np.ndarray, which: np.ndarray, owner: np.ndarray):
        block = min(2, m)
        shift: dict[int, int] = {}
        for end in range(block, m + 1):  # the nearest end of a block is the last one set
            shift.update(dict.fromkeys(self._blocks(patterns, end).tolist(), m - end))
        last = self._blocks(patterns, m)
        order = np.argsort(last, kind="stable")
        ends, at = np.unique(last[order], return_index=True)
        bucket = dict(zip(ends.tolist(), zip(at.tolist(), [*at[1:].tolist(), len(order)])))
        # Owners of each pattern, in the patterns' new order.
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs = np.unique(place[which] * (len(self.items) + 1) + owner + 1)
        held, owned = np.divmod(pairs, len(self.items) + 1)
        starts = np.searchsorted(held, np.arange(len(order) + 1))
        return m, block, shift, bucket, patterns[order], starts, owned - 1

    def find(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Where patterns occur in a text, and the items that have them."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        words = numbers.tolist()
        for m, block, shift, bucket, patterns, starts, owned in self.groups:
            end, last, longest = m, len(words), m - block + 1
            while end <= last:
                key = words[end - 1] if block == 1 else words[end - 2] * self.base + words[end - 1]
                step = shift.get(key, longest)
                if not step:
                    a, b = bucket[key]
                    for k in (a + np.flatnonzero((patterns[a:b] == numbers[end - m : end]).all(axis=1))).tolist():
                        spans.append((end - m, end))
                        found.update(owned[starts[k] : starts[k + 1]].tolist())
                    step = 1
                end += step
        return spans, {self.items[k] for k in found if k >= 0}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    return common.split_words(common.mapped(texts, WORD_MAP))


def _packed(items: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, items.schema) as writer:
        writer.write_table(items)
    return sink.getvalue().to_pybytes()


def _searcher(block: bytes, window: int):
    @F.arrow_udf(SEARCHED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
        search = Search(pa.ipc.open_stream(block).read_all(), window)
        for texts in batches:
            rows = []
            for part in common.slices(texts):
                codes, bounds, words = words_of(part)
                number = np.array([search.vocabulary.get(w, 0) for w in words.to_pylist()] or [0])
                numbers = number[codes]
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    spans, items = search.find(numbers[a:b])
                    rows.append(
                        {
                            "n_words": b - a,
                            "spans": [{"start": s, "stop": e} for s, e in merged(spans)],
                            "items": sorted(items),
                        }
                    )
            yield pa.array(rows, kind)
        common.release()

    return run


def _stretches(window: int):
    kind = pa.schema([("item", pa.string()), ("words", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in common.slices(batch.column(1)):
                codes, bounds, words = words_of(part)
                names = batch.column(0).slice(done, len(part)).to_pylist()
                done += len(part)
                for name, a, b in zip(names, bounds[:-1].tolist(), bounds[1:].tolist()):
                    for start in range(a, max(b - window + 1, a + (b > a)), STRETCH):
                        own = words.take(pa.array(codes[start : min(b, start + STRETCH + window - 1)])).to_pylist()
                        yield pa.RecordBatch.from_pydict({"item": [name], "words": [own]}, schema=kind)

    return cut


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Stretches of items in blocks of about ``limit`` bytes, each taken from a written table."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    cut = rows.filter("text IS NOT NULL").mapInArrow(_stretches(window), "item string, words array<string>")
    cut = common.stored(cut.distinct(), "benchmark")  # copies of an item are one
    size = F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 1))
    blocks = max(1, -(-(cut.agg(size.alias("n")).first()["n"] or 0) // limit))
    for k in range(blocks):
        yield cut.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k).toArrow()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows with ``words`` (their number), ``hits`` (spans of words) and ``items`` (ids)."""
    common.ship(docs.sparkSession)
    docs = docs.drop("words", "hits", "items")
    blocks = item_blocks(benchmark, item_col, item_text_col, window)
    first, second = next(blocks), next(blocks, None)

    def found(block: pa.Table):
        return _searcher(_packed(block), window)(F.col(text_col))

    if second is None:
        searched = docs.withColumn("__found", found(first))
        return _columns(searched, docs.columns, "__found")
    numbered = docs.withColumn("__number", F.monotonically_increasing_id())
    numbered = common.stored(numbered, "searched")
    texts = numbered.select("__number", text_col)
    parts = [common.stored(texts.select("__number", found(first).alias("f")), "hits-0")]
    del first
    for k, block in enumerate(itertools.chain([second], blocks)):
        hits = texts.select("__number", found(block).alias("f")).filter(F.size("f.spans") > 0)
        parts.append(common.stored(hits, f"hits-{k + 1}"))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    per_row = every.groupBy("__number").agg(
        F.max("f.n_words").alias("words"),
        _merged_spans(F.flatten(F.collect_list("f.spans"))).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("items"),
    )
    return numbered.join(per_row, "__number").select(*docs.columns, "words", "hits", "items")


def _columns(searched: DataFrame, kept: list[str], found: str) -> DataFrame:
    return searched.select(
        *kept,
        F.col(f"{found}.n_words").alias("words"),
        F.col(f"{found}.spans").alias("hits"),
        F.col(f"{found}.items").alias("items"),
    )


def _merged_spans(spans: Column) -> Column:
    """Spans that touch or overlap become one, as ``merged`` does."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        new = F.concat(done, F.array(span))
        return F.when((F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["stop"]), joined).otherwise(new)

    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return F.aggregate(F.sort_array(spans), empty, add)
