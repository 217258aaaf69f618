"""Near duplicates by MinHash bands, odd sketches, and a check on full shingle sets.

1. **Signatures.** Each text's distinct word shingles are hashed to 64 bits; 120
   MinHash samples of them are taken. Texts with equal sets become one node, so
   exact copies cost one row however many there are.
2. **Bands.** Nodes that agree in all samples of a band share a bucket. With the
   rows and bands used, a pair at the threshold shares none with a probability
   below one in a million.
3. **Odd sketches.** The samples are folded into a parity bitmap: each toggles the
   bit that it hashes to. The bits in which two bitmaps differ estimate how many
   samples differ, precisely so where similarity is high. A candidate whose estimate
   is more than six standard deviations under the threshold is dropped. A second
   bitmap folds the whole set; the bits in which two of these differ are never more
   than the elements in which the sets differ, which bounds the similarity from
   above without any error.
4. **Links.** Each bucket's smallest node is its hub, and every member is first
   compared with the hub; buckets with more lone nodes than a block holds get further
   hubs as long as these join many. Lone are the members outside the bucket's largest
   component. They are compared with the bucket's other members by both bitmaps, and
   one pair per two components that may be linked is sent on. A bucket that fits a
   block is compared within it, each row sent once; in larger ones both sides come in
   blocks of bounded size. Each pair sent on is confirmed on the two full sets.
   Confirmed pairs join components. Where some pair failed, the nodes for which it
   stood are compared again without it and with more pairs per node, the last time with
   all that may still be linked, written in portions, so it ends with every pair in a
   bucket confirmed, refuted, or inside one component. No step drops any.
5. **Components** are found by alternating stars, in a few rounds on written tables.

Defined cases: null texts, empty texts and texts without words have an empty set
and are linked with nothing. A text of fewer words than a shingle has one shingle,
the whole sequence. Rows that repeat a doc_id and text share one decision. A null
doc_id never names a component that has another id; where there is none, its rows
are all kept. Texts may be of any length: one task reads a text whole, with memory in
proportion, and its full set travels as eight bytes per shingle. An empty table gives
an empty result. Other columns are not carried along; ``text_hash`` tells apart rows that repeat a doc_id with another text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import common

SAMPLES = 120
SKETCH_BITS = 512
PARITY_BITS = 2048
BLOCK = 2_000
#: Pairs per node beyond those that join two components, round by round; the last sends all that may be linked.
ROUNDS = (0, 8, None)
#: Refuted pairs that a node carries along, so that others are chosen; all are left out afterwards.
KNOWN = 64
PORTION = 1 << 16
SLICE_BYTES = 2 << 20
SIGNATURE = "struct<n:long,fingerprint:binary,bands:array<long>,sketch:binary,parity:binary>"

_RANDOM = np.random.RandomState(20)
FACTORS = (_RANDOM.randint(0, 2**63, SAMPLES, np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
BAND_FACTORS = (_RANDOM.randint(0, 2**63, SAMPLES, np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def band_shape(percent: int) -> tuple[int, int]:
    """(rows, bands) whose product is at most SAMPLES and whose misses are under 1e-6."""
    for rows in range(6, 0, -1):
        bands = SAMPLES // rows
        if (1 - (percent / 100) ** rows) ** bands < 1e-6:
            return rows, bands
    return 1, SAMPLES


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the bounds of each text's."""
    codes, bounds, words = common.split_words(common.mapped(texts, common.ascii_lower()))
    if not len(codes):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False))[codes]
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(codes)) - bounds[:-1][owner]
    taken = np.minimum(n, width)[owner]
    starts = np.flatnonzero(place + taken <= n[owner])
    total = np.zeros(len(starts), np.uint64)
    for j in range(width):
        more = taken[starts] > j
        part = np.where(more, hashed[np.minimum(starts + j, len(hashed) - 1)], np.uint64(j + 1))
        total = common.mixed(total * np.uint64(0x9E3779B97F4A7C15) + part)
    owner = owner[starts]
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    first = np.ones(len(total), bool)
    first[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    total, owner = total[first], owner[first]
    return total, np.searchsorted(owner, np.arange(len(n) + 1))


def _toggled(bit: np.ndarray, owner: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Parity bitmaps, one row of bytes per owner."""
    odd = np.zeros((n, bits), np.uint8)
    np.add.at(odd, (owner, bit), 1)
    return np.packbits(odd & 1, axis=1)


def signatures(texts: pa.Array, width: int, rows: int, bands: int) -> list[dict]:
    hashes, bounds = shingle_sets(texts, width)
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    out: list[dict] = [{"n": 0} for _ in range(len(n))]
    if not len(full):
        return out
    starts = bounds[:-1][full]
    samples = np.empty((len(full), SAMPLES), np.uint64)
    for i, factor in enumerate(FACTORS):
        samples[:, i] = np.minimum.reduceat(hashes * factor, starts)
    folded = common.mixed(samples * BAND_FACTORS)
    keys = folded[:, : rows * bands].reshape(len(full), bands, rows)
    keys = common.mixed(keys.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)
    places = (folded % np.uint64(SKETCH_BITS)).astype(np.int64)
    sketch = _toggled(places.ravel(), np.repeat(np.arange(len(full)), SAMPLES), len(full), SKETCH_BITS)
    owner = np.repeat(np.arange(len(full)), n[full])
    parity = _toggled((hashes % np.uint64(PARITY_BITS)).astype(np.int64), owner, len(full), PARITY_BITS)
    for i, text in enumerate(full.tolist()):
        own = hashes[bounds[text] : bounds[text + 1]]
        out[text] = {
            "n": len(own),
            "fingerprint": _fingerprint(own),
            "bands": keys[i].tolist(),
            "sketch": sketch[i].tobytes(),
            "parity": parity[i].tobytes(),
        }
    return out


def _signature_udf(width: int, rows: int, bands: int):
    kind = pa.struct(
        [
            ("n", pa.int64()),
            ("fingerprint", pa.binary()),
            ("bands", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
            ("parity", pa.binary()),
        ]
    )

    @F.arrow_udf(SIGNATURE)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for part in common.slices(texts, SLICE_BYTES):
                found += signatures(part, width, rows, bands)
            yield pa.array(found, kind)
        common.release()

    return sign


def _fingerprint(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


SETS = "fingerprint binary, members binary"
#: Two blocks of a bucket.
PLACE = ("key", "lone_block", "block")
SENT = "key long, lone_block long, block long, tree long, a long, b long"


def _full_sets(width: int):
    """Texts' full sets, and the fingerprints by which their nodes are known."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch.column(0), SLICE_BYTES):
                hashes, bounds = shingle_sets(part, width)
                own = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                names, sets = [_fingerprint(h) for h in own], [h.tobytes() for h in own]
                columns = [pa.array(names, pa.binary()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "members"])
        common.release()

    return shingles


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width // 64)


def differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def estimate(bits: np.ndarray) -> np.ndarray:
    """Similarity by the number of bits in which two odd sketches differ."""
    rest = np.maximum(1 - 2 * bits / SKETCH_BITS, 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(rest)


def lowest_estimate(percent: int) -> float:
    share = percent / 100
    return share - 6 * np.sqrt(share * (1 - share) / SAMPLES)


def may_link(sizes: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of that summed size that differ in that many bits, at least, can be linked."""
    return 100 * (sizes - bits) >= percent * (sizes + bits)


def _sketch_filter(percent: int):
    lowest = lowest_estimate(percent)

    @F.arrow_udf("boolean")
    def passes(n: pa.Array, a: pa.Array, b: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        if not len(n):
            return pa.array([], pa.bool_())
        sketch = differing(_matrix(a, SKETCH_BITS), _matrix(b, SKETCH_BITS))
        parity = differing(_matrix(x, PARITY_BITS), _matrix(y, PARITY_BITS))
        return pa.array((estimate(sketch) >= lowest) & may_link(n.to_numpy(), parity, percent))

    return passes


def _linked(percent: int):
    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
            if len(x) > len(y):
                x, y = y, x
            common_ = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            out.append(100 * common_ >= percent * (len(x) + len(y) - common_))
        return pa.array(out, pa.bool_())

    return linked


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    Alternating large and small stars; a hub's many edges are dealt by the other end.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = common.stored(edges, "stars")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = common.stored(large.filter("u <> v"), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.stored(lower.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars")
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("s")
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


class _Forest:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal first three columns, over the borders of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in (0, 1, 2)]
        cuts = np.flatnonzero(np.any([key[1:] != key[:-1] for key in keys], axis=0)) + 1
        if held and len(batch) and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in (0, 1, 2)):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *cuts], [*cuts, len(batch)]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _spanning(percent: int, extra: int | None):
    """Pairs of two blocks of a bucket: enough to join what may be linked, and ``extra`` per node, or all."""
    lowest = lowest_estimate(percent)

    def candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each node of the lone block those that may be linked in the other, or in its own, and how far they differ."""
        lone = group.column("lone").to_numpy()
        node, part = group.column("node").to_numpy(), group.column("component").to_numpy()
        size, refuted = group.column("n").to_numpy(), group.column("refuted").combine_chunks()
        parity = _matrix(group.column("parity").combine_chunks(), PARITY_BITS)
        sketch = _matrix(group.column("sketch").combine_chunks(), SKETCH_BITS)
        same = group.column("lone_block")[0] == group.column("block")[0]
        members = np.arange(len(lone)) if same else np.flatnonzero(~lone)
        for i in np.flatnonzero(lone).tolist():
            apart = members[part[members] != part[i]]
            if same:  # two lone nodes of one block meet once
                apart = apart[~lone[apart] | (node[apart] > node[i])]
            # The smaller size bounds what two sets share.
            small, large = np.minimum(size[apart], size[i]), np.maximum(size[apart], size[i])
            apart = apart[100 * small >= percent * large]
            apart = apart[estimate(differing(sketch[apart], sketch[i])) >= lowest]
            differ = differing(parity[apart], parity[i])
            ok = may_link(size[apart] + size[i], differ, percent)
            apart, differ = apart[ok], differ[ok]
            if refuted[i].is_valid and len(refuted[i]):
                fresh = ~np.isin(node[apart], refuted[i].values.to_numpy())
                apart, differ = apart[fresh], differ[fresh]
            if len(apart):
                yield i, apart, differ / (size[apart] + size[i])

    def portions(group: pa.Table) -> Iterator[dict[str, np.ndarray]]:
        """Pairs a, b; unless all are sent, with the tree that they are of, and each of its nodes as a without b."""
        node, part = group.column("node").to_numpy(), group.column("component").to_numpy()
        first: list[np.ndarray] = []
        second: list[np.ndarray] = []
        bits: list[np.ndarray] = []
        held = 0
        for i, apart, differ in candidates(group):
            first.append(np.full(len(apart), i, np.int32))
            second.append(apart.astype(np.int32))
            bits.append(differ.astype(np.float32))
            held += len(apart)
            if extra is None and held >= PORTION:
                yield {"a": node[np.concatenate(first)], "b": node[np.concatenate(second)]}
                first, second, held = [], [], 0
            if extra is None:
                bits = []
        if not first:
            return
        i_all, j_all = np.concatenate(first), np.concatenate(second)
        if extra is None:
            yield {"a": node[i_all], "b": node[j_all]}
            return
        forest, used, chosen = _Forest(), {}, []
        for k in np.argsort(np.concatenate(bits), kind="stable"):
            i, j = int(i_all[k]), int(j_all[k])
            if forest.join(int(part[i]), int(part[j])) or used.get(i, 0) < extra:
                used[i] = used.get(i, 0) + 1
                chosen.append(k)
        tree = lambda rows: np.array([forest.root(int(x)) for x in part[rows]], np.int64)
        met = np.unique(np.concatenate([i_all, j_all]))
        i_all, j_all = i_all[chosen], j_all[chosen]
        yield {"a": node[i_all], "b": node[j_all], "tree": tree(i_all)}
        yield {"a": node[met], "tree": tree(met)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            place = [group.column(name)[0] for name in PLACE]
            for found in portions(group):
                n = len(found["a"])
                columns = [pa.repeat(value, n) for value in place]
                columns += [pa.array(found[c]) if c in found else pa.nulls(n, pa.int64()) for c in ("tree", "a", "b")]
                yield pa.RecordBatch.from_arrays(columns, [*PLACE, "tree", "a", "b"])

    return run


class _Nodes:
    """The distinct sets of a table, and what is asked about them."""

    def __init__(self, docs: DataFrame, signed: DataFrame, width: int, percent: int):
        self.spark, self.width, self.percent = docs.sparkSession, width, percent
        rows = signed.filter("fingerprint IS NOT NULL").groupBy("fingerprint").agg(
            F.min("doc_id").alias("first_id"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.first("parity").alias("parity"),
        )
        self.rows = common.stored(rows.withColumn("node", F.monotonically_increasing_id()), "nodes")
        slots = self.rows.select("node", F.explode("bands").alias("key"))
        hubs = slots.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members"))
        shared = slots.join(hubs.filter("members > 1"), "key")
        self.slots = common.stored(shared, "buckets")
        #: Rows of buckets that their hubs have not settled, and for which no pairs stand that are all links.
        self.open = self.slots.filter("members > 2")
        self.sets = self._sets(docs)

    def _sets(self, docs: DataFrame) -> DataFrame:
        """Full sets of all nodes that share a bucket, from the texts again."""
        asked = self.slots.select("node").distinct()
        ids = common.stored(self.rows.join(asked, "node", "left_semi").select("first_id", "fingerprint", "node"), "asked")
        texts = docs.join(ids.select("first_id"), F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
        # Not a column function: the join would ask for its result above and below the semi join.
        held = texts.select("text").mapInArrow(_full_sets(self.width), SETS)
        named = held.join(ids, "fingerprint")
        return common.stored(named.groupBy("node").agg(F.first("members").alias("members")), "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs with ``linked``, by their full sets."""
        own = self.sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
        hub = self.sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
        both = pairs.join(own, "b").join(hub, "a")
        checked = both.select("a", "b", _linked(self.percent)("left", "right").alias("linked"))
        return common.stored(checked, "confirmed")

    def star_pairs(self) -> DataFrame:
        """Hub and member of every bucket, as far as the sketches let them pass."""
        pairs = self.slots.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        return self.passing(pairs)

    def passing(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the sketches let pass."""
        rows = self.rows.select("node", "n", "sketch", "parity")
        left = rows.select(*(F.col(c).alias(d) for c, d in zip(rows.columns, ("a", "n_a", "sketch_a", "parity_a"))))
        right = rows.select(*(F.col(c).alias(d) for c, d in zip(rows.columns, ("b", "n_b", "sketch_b", "parity_b"))))
        passes = _sketch_filter(self.percent)(
            F.col("n_a") + F.col("n_b"), "sketch_a", "sketch_b", "parity_a", "parity_b"
        )
        return pairs.join(right, "b").join(left, "a").filter(passes).select("a", "b")

    def wide(self, slots: DataFrame, parts: DataFrame) -> DataFrame:
        """Rows of buckets with components; nodes outside the largest component of a bucket are lone in it."""
        wide = slots.select("key", "node").join(parts, "node", "left")
        wide = wide.withColumn("component", F.coalesce("component", "node"))
        main = wide.groupBy("key", "component").agg(F.count("*").alias("rows"))
        main = main.groupBy("key").agg(F.max_by("component", F.struct("rows", "component")).alias("main"))
        return wide.join(main, "key").select("key", "node", "component", (F.col("component") != F.col("main")).alias("lone"))

    def further_hubs(self, parts: DataFrame, refuted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components and refuted pairs after buckets of many lone nodes have met further hubs.

        Every round gives such a bucket one more hub, the member with the most rows in its
        buckets, since this is the one nearest to the others; it costs one pair per row.
        It ends when a round leaves more than nine tenths of the lone rows.
        """
        large, before = self.open.filter(F.col("members") > BLOCK), None
        if large.isEmpty():
            return parts, refuted
        near = common.stored(self.slots.groupBy("node").agg(F.sum("members").alias("near")), "near")
        met = large.select("key", F.col("hub").alias("node")).distinct()
        while True:
            wide = common.stored(self.wide(large, parts), "wide")
            many = wide.groupBy("key").agg(F.count_if("lone").alias("lone_rows")).filter(F.col("lone_rows") > BLOCK)
            fresh = wide.join(many, "key").join(met, ["key", "node"], "left_anti").join(near, "node")
            hubs = fresh.groupBy("key").agg(
                F.max("lone_rows").alias("lone_rows"),
                F.max_by(F.struct("node", "component"), F.struct("near", "node")).alias("hub"),
            )
            hubs = common.stored(hubs, "hubs")
            left = hubs.agg(F.sum("lone_rows")).first()[0]
            if not left or before and left > 0.9 * before:
                return parts, refuted
            before = left
            pairs = wide.join(hubs, "key").filter("component <> hub.component")
            pairs = pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
            pairs = pairs.distinct().join(refuted, ["a", "b"], "left_anti")
            found = self.confirmed(common.stored(self.passing(pairs), "hub-pairs"))
            parts = self.merged(parts, found.filter("linked").select("a", "b"))
            refuted = refuted.unionByName(found.filter("NOT linked").select("a", "b"))
            met = met.unionByName(hubs.select("key", "hub.node"))

    def merged(self, parts: DataFrame, links: DataFrame) -> DataFrame:
        """Components joined by more links."""
        joined = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(joined.unionByName(links))

    def dealt(self, parts: DataFrame, refuted: DataFrame) -> DataFrame:
        """Rows of two blocks of a bucket each: lone nodes, and those to compare them with.

        A bucket that fits a block is one, with itself. In others blocks of lone nodes
        come first: two of them meet once, and each meets all blocks of other nodes.
        """
        wide = common.stored(self.wide(self.open, parts), "wide")
        sizes = wide.groupBy("key").agg(F.count_if("lone").alias("l"), F.count_if(~F.col("lone")).alias("m"))
        fits = F.col("l") + F.col("m") <= BLOCK
        sizes = sizes.filter("l > 0").select(
            "key",
            F.when(fits, 1).otherwise(F.ceil(F.col("l") / BLOCK)).alias("l"),
            F.when(fits, 0).otherwise(F.ceil(F.col("m") / BLOCK)).alias("m"),
        )
        code = F.xxhash64("node")
        own = F.when(F.col("lone"), F.pmod(code, F.col("l")))
        own = own.otherwise(F.when(F.col("m") > 0, F.col("l") + F.pmod(code, F.col("m"))).otherwise(0))
        wide = wide.join(sizes, "key").withColumn("own", own)
        # One row per block that this row's block meets; lone nodes come as such to their own block and later ones.
        first = F.lit(0).cast("long")
        last = F.when(F.col("lone"), F.col("l") + F.col("m") - 1).otherwise(F.col("l") - 1)
        wide = wide.withColumn("other", F.explode(F.sequence(first, last)))
        left = F.col("lone") & (F.col("other") >= F.col("own"))
        rows = wide.select(
            "key",
            F.when(left, F.col("own")).otherwise(F.col("other")).alias("lone_block"),
            F.when(left, F.col("other")).otherwise(F.col("own")).alias("block"),
            left.alias("lone"),
            "node",
            "component",
        )
        rows = rows.join(self.rows.select("node", "n", "parity", "sketch"), "node")
        each = refuted.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            refuted.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        order = Window.partitionBy("node").orderBy("other")
        each = each.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= KNOWN)
        each = each.groupBy("node").agg(F.collect_list("other").alias("refuted")).withColumn("lone", F.lit(True))
        rows = rows.join(each, ["node", "lone"], "left")
        return rows.select(
            "key", "lone_block", "block", "lone", "node", "component", "n", "parity", "sketch", "refuted"
        )

    def cross_pairs(self, parts: DataFrame, refuted: DataFrame, extra: int | None) -> DataFrame:
        """Pairs between components of a bucket that are not joined yet; unless all, as ``portions`` has them."""
        rows = self.dealt(parts, refuted).repartition(common.partitions(self.spark), *PLACE)
        rows = rows.sortWithinPartitions(*PLACE)
        sent = rows.mapInArrow(_spanning(self.percent, extra), SENT)
        return sent if extra is not None else sent.select("a", "b").distinct()

    def components(self) -> DataFrame:
        found = self.confirmed(common.stored(self.star_pairs(), "star-pairs"))
        refuted = found.filter("NOT linked").select("a", "b")
        links = found.filter("linked").select("a", "b")
        parts = components(links)
        parts, refuted = self.further_hubs(parts, refuted)
        for extra in ROUNDS:
            sent = common.stored(self.cross_pairs(parts, refuted, extra), "cross-pairs")
            pairs = sent.filter("b IS NOT NULL")
            found = self.confirmed(pairs.select("a", "b").distinct().join(refuted, ["a", "b"], "left_anti"))
            links = found.filter("linked").select("a", "b")
            if not links.isEmpty():
                parts = self.merged(parts, links)
            if extra is None:
                break
            # Trees whose pairs are all links are joined. Pairs refuted before stand for others as those refuted now do.
            failed = pairs.join(links, ["a", "b"], "left_anti").select(*PLACE, "tree").distinct()
            again = sent.filter("b IS NULL").join(failed, [*PLACE, "tree"], "left_semi")
            again = again.select("key", F.col("a").alias("node")).distinct()
            self.open = common.stored(self.open.join(again, ["key", "node"], "left_semi"), "open-buckets")
            if self.open.isEmpty():
                break
            refuted = refuted.unionByName(found.filter("NOT linked").select("a", "b"))
        return parts


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) of every row."""
    common.ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = docs.withColumn("s", _signature_udf(width, *band_shape(percent))("text"))
    signed = common.stored(signed.select("doc_id", F.xxhash64("text").alias("text_hash"), "s.*"), "signatures")
    nodes = _Nodes(docs, signed, width, percent)
    parts = nodes.components()
    # Only nodes with a link have a row here; all others are their own component.
    linked = nodes.rows.select("fingerprint", "first_id", "node").join(parts, "node")
    ids = linked.groupBy("component").agg(F.min("first_id").alias("joined_id"))
    linked = common.stored(linked.join(ids, "component").select("fingerprint", "joined_id"), "linked")
    classes = nodes.rows.select("fingerprint", "first_id").join(linked, "fingerprint", "left")
    classes = classes.select("fingerprint", F.coalesce("joined_id", "first_id").alias("class_id"))
    joined = signed.select("doc_id", "text_hash", "n", "fingerprint").join(classes, "fingerprint", "left")
    component = F.when(F.col("fingerprint").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
    )
