"""How the words of each source differ from its language's and from the other sources'.

1. **Blocks.** Each task reads documents into an index in memory: a dictionary of terms,
   and postings (term, group, occurrences, documents) that are summed whenever they have
   doubled. When ``BLOCK_POSTINGS`` are full, or the documents end, the block is spilled as
   runs, one per hash shard of (language, term), sorted by language and term, in chunks of
   ``CHUNK_POSTINGS``. The chunks are a written table in the shared folder.
2. **Merge.** A shard's chunks arrive in the order of their first terms, whatever run they
   are from. A heap holds the chunks that are open by their next term; terms before the
   next chunk's first are taken from all of them and added up, which gives their
   frequencies in every group. Only chunks that overlap are in memory, and what one
   term fills many chunks with is added up as it comes. Terms in fewer than
   ``MIN_DOCS`` documents of their language go here.
3. **Corrections.** With p0 the probability of a term that a group lacks, the sum over all
   kept terms of a pair of groups is
     V f(p0, q0), as if both lacked every term,
     + the change for each term of the first group, as if the second lacked it,
     + the change for each term of the second, as if the first lacked it,
     + for each term that both have, what these three terms miss.
   The first three need each group's terms only by their number per probability. The last
   is streamed: a term's groups give one correction per pair, added up in each task in
   arrays of bounded size. So terms that are absent cost nothing.

All arithmetic is on whole numbers. Joins on groups are salted, as one group may hold
a third of all postings; pairs of groups are as many as the rows of the result.

Defined cases: null text, language and source are ''. A null or empty text makes its
group occur. Rows that repeat a doc_id are documents of their own. A language without
kept terms gives 0 for every pair and no terms. A text is read in one task, with some 30
bytes per byte. Ties of a value go to the smaller item, byte by byte. An empty table
gives an empty result. Other columns of the input are not carried along.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import common

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
BLOCK_POSTINGS = 500_000
CHUNK_POSTINGS = 2_000
MERGED_POSTINGS = 200_000
SALTS = 16
PAIR_BLOCK = 1 << 21
HELD_PAIRS = 1 << 20

# Terms are runs of ASCII letters and of all that is not ASCII; only A-Z are lowered.
TERM_MAP = common.ascii_lower()
TERM_MAP[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32

#: Stands for "the group occurs" among a group's terms; no term is empty.
OCCURS = ""

CHUNK = (
    "shard int, lang string, first string, terms array<string>, ends array<int>,"
    "sources array<string>, counts array<long>, docs array<long>"
)
FREQUENCIES = "lang string, term string, source string, count long, lang_count long, groups int, leads boolean"
CORRECTIONS = "lang string, source string, item string, value long"


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    return keys[at], *(np.add.reduceat(v[order], at) if len(at) else v for v in values)


class Block:
    """Postings of the documents since the last spill."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.terms: dict[str, int] = {OCCURS: 0}
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.kept = 0

    def add(self, texts: pa.Array, langs: list[str], sources: list[str]) -> None:
        codes, bounds, words = common.split_words(common.mapped(texts, TERM_MAP))
        own = np.array([self.terms.setdefault(w, len(self.terms)) for w in words.to_pylist()] or [0], np.int64)
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)], np.int64)
        document = np.repeat(np.arange(len(group)), np.diff(bounds))
        number = np.int64(max(len(words), 1))
        pairs, count = _summed(document * number + codes, np.ones(len(codes), np.int64))
        document, code = np.divmod(pairs, number)
        self._put((group[document] << 32) + own[code], count, np.ones(len(pairs), np.int64))
        nothing = np.zeros(len(group), np.int64)
        self._put(group << 32, nothing, nothing + 1)

    def _put(self, *part: np.ndarray) -> None:
        self.parts.append(part)
        self.held += len(part[0])
        if self.held > 2 * self.kept + CHUNK_POSTINGS:
            self._shrink()

    def _shrink(self) -> None:
        if self.parts:
            self.parts = [_summed(*map(np.concatenate, zip(*self.parts)))]
            self.held = self.kept = len(self.parts[0][0])

    @property
    def full(self) -> bool:
        if self.held >= BLOCK_POSTINGS:
            self._shrink()
        return self.held >= BLOCK_POSTINGS or len(self.terms) >= BLOCK_POSTINGS

    def runs(self) -> Iterator[dict]:
        """All postings as chunks of runs, each run in the order of its terms."""
        self._shrink()
        if not self.parts:
            return
        keys, counts, docs = self.parts[0]
        group, term = keys >> 32, keys & 0xFFFFFFFF
        names = sorted(self.terms)
        place = np.empty(len(names), np.int64)
        place[[self.terms[t] for t in names]] = np.arange(len(names))
        langs = sorted({lang for lang, _ in self.groups})
        of_lang = {lang: i for i, lang in enumerate(langs)}
        lang = np.array([of_lang[g[0]] for g in self.groups], np.int64)[group]
        sources = [g[1] for g in self.groups]
        shard = self._shards(names, place[term], langs, lang)
        order = np.lexsort((group, place[term], lang, shard))
        shard, lang, place, group = shard[order], lang[order], place[term][order], group[order]
        counts, docs = counts[order], docs[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(lang) != 0)]))
        fresh = np.zeros(len(place), bool)
        fresh[new] = True
        run = np.flatnonzero(np.concatenate([[True], (np.diff(shard) != 0) | (np.diff(lang) != 0)]))
        for a, b in zip(run, np.append(run[1:], len(place))):
            for start in range(a, b, CHUNK_POSTINGS):
                stop = min(start + CHUNK_POSTINGS, b)
                heads = np.flatnonzero(fresh[start:stop])
                heads = heads if len(heads) and heads[0] == 0 else np.concatenate([[0], heads])
                terms = [names[i] for i in place[start + heads]]
                yield {
                    "shard": int(shard[start]),
                    "lang": langs[lang[start]],
                    "first": terms[0],
                    "terms": terms,
                    "ends": [*heads[1:].tolist(), int(stop - start)],
                    "sources": [sources[g] for g in group[start:stop]],
                    "counts": counts[start:stop].tolist(),
                    "docs": docs[start:stop].tolist(),
                }

    def _shards(self, names: list[str], term: np.ndarray, langs: list[str], lang: np.ndarray) -> np.ndarray:
        """Shard of each posting by its language and term, the same in every task."""
        terms, salts = (np.array([xxhash.xxh64_intdigest(x.encode()) for x in y], np.uint64) for y in (names, langs))
        return (common.mixed(terms[term] + salts[lang]) % np.uint64(self.shards)).astype(np.int64)


def chunk_schema() -> pa.Schema:
    return pa.schema(
        [
            ("shard", pa.int32()),
            ("lang", pa.string()),
            ("first", pa.string()),
            ("terms", pa.list_(pa.string())),
            ("ends", pa.list_(pa.int32())),
            ("sources", pa.list_(pa.string())),
            ("counts", pa.list_(pa.int64())),
            ("docs", pa.list_(pa.int64())),
        ]
    )


def _spiller(shards: int):
    kind = chunk_schema()

    def spilled(block: Block) -> Iterator[pa.RecordBatch]:
        rows = []
        for chunk in block.runs():
            rows.append(chunk)
            if len(rows) == 200:
                yield pa.RecordBatch.from_pylist(rows, kind)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)
        block.clear()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shards)
        for batch in batches:
            done, langs, sources = 0, batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for part in common.slices(batch.column(0)):
                stop = done + len(part)
                block.add(part, langs[done:stop], sources[done:stop])
                done = stop
                if block.full:
                    yield from spilled(block)
            pa.default_memory_pool().release_unused()
        yield from spilled(block)
        common.release()

    return index


def spill_runs(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The sorted runs of all blocks as a written table of chunks."""
    rows = docs.select(*(common.text_or_empty(c).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    spilled = rows.mapInArrow(_spiller(4 * common.partitions(docs.sparkSession)), CHUNK)
    return common.stored(spilled, "runs")


class _Open:
    """A chunk in the merge, from one of its terms on."""

    def __init__(self, shard: int, lang: str, terms: list[str], ends: np.ndarray, sources: pa.Array, *sums: np.ndarray):
        self.shard, self.lang, self.terms, self.ends = shard, lang, terms, ends
        self.sources, self.sums = sources, sums
        self.at = 0

    @property
    def key(self) -> tuple[int, str, str]:
        return self.shard, self.lang, self.terms[self.at]

    @property
    def held(self) -> int:
        return int(self.ends[-1] - self.ends[self.at])

    def until(self, limit: tuple | None) -> tuple | None:
        """Takes the postings of terms before ``limit``: language, terms, rows of each, sources, sums."""
        stop = len(self.terms)
        if limit is not None and (self.shard, self.lang) == limit[:2]:
            stop = bisect.bisect_left(self.terms, limit[2], self.at)
        if stop == self.at:
            return None
        a, b = int(self.ends[self.at]), int(self.ends[stop])
        taken = (
            self.lang, self.terms[self.at : stop], np.diff(self.ends[self.at : stop + 1]),
            self.sources.slice(a, b - a), *(x[a:b] for x in self.sums),
        )
        self.at = stop
        return taken


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Open]:
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        shards, langs = columns["shard"].to_pylist(), columns["lang"].to_pylist()
        for i in range(len(batch)):
            lists = {c: columns[c][i].values for c in ("terms", "ends", "sources", "counts", "docs")}
            ends = np.concatenate([[0], lists["ends"].to_numpy()])
            counts, docs = lists["counts"].to_numpy(), lists["docs"].to_numpy()
            yield _Open(shards[i], langs[i], lists["terms"].to_pylist(), ends, lists["sources"], counts, docs)


def _joined(parts: list[tuple]) -> dict[str, np.ndarray | pa.Array]:
    """Postings of several runs added up: one row per language, term and source, rows of a term together."""
    langs = sorted({p[0] for p in parts})
    lang = np.concatenate([np.full(int(p[2].sum()), langs.index(p[0])) for p in parts])
    names: dict[str, int] = {}
    term = np.concatenate([np.repeat([names.setdefault(t, len(names)) for t in p[1]], p[2]) for p in parts])
    coded = pa.concat_arrays([p[3] for p in parts]).dictionary_encode()
    source, sources = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    key = (lang * len(names) + term) * len(sources) + source
    key, count, docs = _summed(key, *(np.concatenate([p[k] for p in parts]) for k in (4, 5)))
    key, source = np.divmod(key, len(sources))
    lang, term = np.divmod(key, len(names))
    return {
        "lang": pa.array(langs).take(pa.array(lang)), "term": pa.array(list(names)).take(pa.array(term)),
        "source": sources.take(pa.array(source)), "count": count, "docs": docs,
        "starts": np.flatnonzero(np.concatenate([[True], np.diff(key) != 0])),
    }


def _compacted(heap: list) -> list:
    """What is open as one chunk per shard and language, equal postings added up."""
    by: dict[tuple, list] = {}
    for _, _, opened in heap:
        by.setdefault((opened.shard, opened.lang), []).append(opened.until(None))
    out = []
    for n, ((shard, lang), parts) in enumerate(sorted(by.items(), key=lambda x: x[0])):
        found = _joined(parts)
        size = np.diff(np.append(found["starts"], len(found["count"])))
        terms = found["term"].take(pa.array(found["starts"])).to_pylist()
        order = np.array(sorted(range(len(terms)), key=terms.__getitem__))
        place = np.repeat(found["starts"][order] - (np.cumsum(size[order]) - size[order]), size[order]) + np.arange(size.sum())
        ends = np.concatenate([[0], np.cumsum(size[order])])
        rows = found["source"].take(pa.array(place)), found["count"][place], found["docs"][place]
        opened = _Open(shard, lang, [terms[i] for i in order], ends, *rows)
        out.append((opened.key, -1 - n, opened))
    return out


def merged(chunks: Iterator[_Open], step: int | None = None) -> Iterator[dict]:
    """All postings added up, in portions; a term is in one portion only.

    ``chunks`` come in the order of shard, language and first term. The heap has the open
    ones by their next term. Whenever ``step`` postings are open, those of terms before
    the next chunk's first are taken from it and leave; where too few can, as one term
    fills the chunks of many runs, what is open is added up.
    """
    step = MERGED_POSTINGS if step is None else step
    heap: list[tuple[tuple, int, _Open]] = []
    held, most = 0, 2 * step

    def before(limit: tuple | None) -> list[tuple]:
        parts = []
        while heap and (limit is None or heap[0][0] < limit):
            _, n, opened = heapq.heappop(heap)
            parts.append(opened.until(limit))
            if opened.at < len(opened.terms):
                heapq.heappush(heap, (opened.key, n, opened))
        return parts

    for n, opened in enumerate(chunks):
        if held >= step:
            parts = before(opened.key)
            if parts:
                held -= sum(len(p[3]) for p in parts)
                yield _joined(parts)
            if held >= most:
                heap = _compacted(heap)
                held = sum(x.held for _, _, x in heap)
                most = max(2 * step, 2 * held)
        heapq.heappush(heap, (opened.key, n, opened))
        held += opened.held
    parts = before(None)
    if parts:
        yield _joined(parts)


def _merger(min_docs: int):
    names = ["lang", "term", "source", "count", "lang_count", "groups", "leads"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in merged(_chunks(batches)):
            starts = found["starts"]
            size = np.diff(np.append(starts, len(found["count"])))
            marks = pc.equal(found["term"], OCCURS).to_numpy(zero_copy_only=False)
            often = np.add.reduceat(found["docs"], starts) >= min_docs
            kept = pa.array(np.repeat(often, size) | marks)
            leads = np.zeros(len(marks), bool)
            leads[starts] = True
            columns = [
                found["lang"], found["term"], found["source"], pa.array(found["count"]),
                pa.array(np.repeat(np.add.reduceat(found["count"], starts), size)),
                pa.array(np.repeat(size, size).astype(np.int32)), pa.array(leads),
            ]
            table = pa.RecordBatch.from_arrays(columns, names).filter(kept)
            for at in range(0, len(table), 50_000):
                yield table.slice(at, 50_000)
        common.release()

    return merge


def frequencies(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per kept term and group that has it, and one with the term '' per group that occurs.

    ``lang_count`` and ``groups`` are the term's occurrences and groups in the language;
    ``leads`` marks one row of each term.
    """
    common.ship(docs.sparkSession)
    runs = spill_runs(docs, text_col, lang_col, source_col)
    dealt = runs.repartition(common.partitions(docs.sparkSession), "shard").sortWithinPartitions("shard", "lang", "first")
    return common.stored(dealt.mapInArrow(_merger(min_docs), FREQUENCIES), "frequencies")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + the whole part of UNIT (count + 1) / (total + terms)."""
    whole = (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", whole, (total + terms).cast("decimal(20,0)")) + 1


def difference(p: Column, q: Column) -> Column:
    """The whole part of (p - q)^2 / q."""
    return F.call_function("div", (p - q) * (p - q), q)


def _correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two groups that share terms, what their separate changes miss, per task.

    Rows come sorted by language and term; a term's rows may be spread over batches.
    """
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    sums = PairSums()
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        lang, term = (table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "term"))
        new = np.flatnonzero(np.concatenate([[True], (np.diff(lang) != 0) | (np.diff(term) != 0)])) if len(lang) else []
        if not len(new):
            continue
        rest = table.slice(int(new[-1]))
        sums.add(table.slice(0, int(new[-1])), new[:-1])
        if sums.large:
            yield from sums.rows(kind)
    if rest is not None:
        sums.add(rest, np.array([0]))
    yield from sums.rows(kind)


class PairSums:
    """Corrections by pair of groups; groups are numbered as they come."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.keys = np.empty(0, np.int64)
        self.values = np.empty(0, np.int64)

    @property
    def large(self) -> bool:
        return len(self.keys) > HELD_PAIRS

    def add(self, table: pa.Table, starts: np.ndarray) -> None:
        """``starts``: where each term's rows begin."""
        n = table.num_rows
        if not n:
            return
        names = zip(table.column("lang").to_pylist(), table.column("source").to_pylist())
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in names], np.int64)
        p, absent = (table.column(c).to_numpy() for c in ("p", "p0"))
        size = np.diff(np.append(starts, n))
        first, width = np.repeat(starts, size), np.repeat(size, size)
        # Every row meets all rows of its term; taken in blocks of rows.
        ends = np.cumsum(width)
        at = 0
        while at < n:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_BLOCK, "right")))
            w = width[at:stop]
            left = np.repeat(np.arange(at, stop), w)
            right = np.repeat(first[at:stop] - (np.cumsum(w) - w), w) + np.arange(w.sum())
            other = left != right
            left, right = left[other], right[other]
            value = (
                _whole(p[left], p[right]) - _whole(p[left], absent[right])
                - _whole(absent[left], p[right]) + _whole(absent[left], absent[right])
            )
            keys, values = _summed((group[left] << 32) + group[right], value)
            keys, values = np.concatenate([self.keys, keys]), np.concatenate([self.values, values])
            self.keys, self.values = _summed(keys, values)
            at = stop

    def rows(self, kind: pa.Schema) -> Iterator[pa.RecordBatch]:
        names = list(self.groups)
        for at in range(0, len(self.keys), 50_000):
            keys = self.keys[at : at + 50_000]
            left, right = [names[i] for i in keys >> 32], [names[i] for i in keys & 0xFFFFFFFF]
            columns = [[g[0] for g in left], [g[1] for g in left], [g[1] for g in right], self.values[at : at + 50_000]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kind.types)], schema=kind)
        self.__init__()


def _whole(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """Ranked pairs of sources and terms of each source: lang, source, part, item, value, rank."""
    found = frequencies(docs, text_col, lang_col, source_col, min_docs)
    kept = found.filter(F.col("term") != OCCURS)
    langs = found.groupBy("lang").agg(
        F.count_if(F.expr("leads AND term <> ''")).alias("terms"), F.sum("count").alias("lang_total")
    )
    groups = found.groupBy("lang", "source").agg(F.sum("count").alias("total")).join(langs, "lang")
    groups = common.stored(
        groups.withColumn("p0", F.when(F.col("terms") > 0, probability(F.lit(0), F.col("total"), F.col("terms")))),
        "groups",
    )
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    spread = groups.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    known = kept.withColumn("salt", salt).join(spread, ["lang", "source", "salt"])
    known = known.withColumn("p", probability(F.col("count"), F.col("total"), F.col("terms")))

    terms = known.withColumn("q", probability(F.col("lang_count"), F.col("lang_total"), F.col("terms")))
    terms = terms.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    pairs = _pairs(known, groups).withColumn("rank", F.row_number().over(best))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def _pairs(known: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (the other source) and value, for all pairs of one language."""
    spark = known.sparkSession
    left = groups.select("lang", "source", "terms", "p0")
    right = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = left.join(right, "lang").filter("source <> item")
    base = base.select(
        "lang", "source", "item", F.coalesce(F.col("terms") * difference(F.col("p0"), F.col("q0")), F.lit(0).cast("long")).alias("value")
    )
    # Terms of a group by their probability, against every other group as if it lacked them.
    alike = known.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    alike = alike.withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS)).cast("int"))
    salted = right.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    met = alike.join(salted, ["lang", "salt"]).filter("source <> item")
    p, p0, q0, n = (F.col(c) for c in ("p", "p0", "q0", "n"))
    ahead = n * (difference(p, q0) - difference(p0, q0))
    behind = n * (difference(q0, p) - difference(q0, p0))
    met = met.groupBy("lang", "source", "item").agg(F.sum(ahead).alias("ahead"), F.sum(behind).alias("behind"))
    # Terms that both have.
    shared = known.filter("groups > 1").select("lang", "term", "source", "p", "p0")
    shared = shared.repartition(common.partitions(spark), "lang", "term").sortWithinPartitions("lang", "term")
    both = shared.mapInArrow(_correct, CORRECTIONS)
    parts = base.unionByName(met.select("lang", "source", "item", F.col("ahead").alias("value")))
    parts = parts.unionByName(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("behind").alias("value")))
    return parts.unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
