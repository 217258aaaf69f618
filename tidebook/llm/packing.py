"""Documents packed into sequences, with lower bounds that say when a packing is best.

1. Every document becomes token ids with a closing id; only documents longer than
   a sequence are cut.
2. Pieces are dealt at random to partitions of about ``PARTITION_PIECES``, and each
   is packed by best-fit decreasing: longest piece first, into the open sequence
   where the least room is left.
3. Dual feasible functions give a lower bound on a partition's sequences: such a
   function maps lengths so that what fits into one sequence still adds up to at
   most one, so no packing has fewer sequences than the mapped sum. A partition that
   meets its bound exactly is certified and done; all are when their sequences
   together are no more than their bounds together, rounded up.
4. Partitions with a gap exchange documents: the pieces of their sequences that are
   not full are dealt anew, to partitions twice as large, and packed again. The new
   packing replaces the old one if it has fewer sequences. This ends when all are
   certified, when a round gains nothing, or after ``ROUNDS``.

The driver sees two sums per round. A partition is a bounded number of rows by a
hash of the row's own number, so no id can make it large.

Defined cases: a null text is empty and has the closing id alone. Rows that repeat
a doc_id are packed as documents of their own. A null doc_id stays null. A long text
is turned into ids by one task, with memory in proportion, and cut into pieces. Equal
lengths are packed in any order. An empty table gives an empty result. Other columns of the input are not carried along.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidebook.llm import common

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
CLOSING = 0
PARTITION_PIECES = 5_000
ROUNDS = 4
CACHED_WORDS = 200_000
SLICE_BYTES = 4 << 20
DUAL_STEPS = 40

# A word of Latin letters, then signs other than the apostrophe: the tokenizer cuts
# it between the two and treats each on its own. Other words go through it whole.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The usual rule by which byte-level vocabularies write bytes as letters."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokens:
    """Ids of words as bytes; words seen lately are kept, at most ``CACHED_WORDS``."""

    LETTERS = _byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join(map(self.LETTERS.__getitem__, part.encode()))
            ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[part] = ids
        return ids

    def of_word(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        if not plain:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        letters, signs = plain.groups()
        return self._part(letters.lower()) + (self._part(signs) if signs else b"")

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text and the closing id. No token spans white space."""
        codes, bounds, words = common.split_words(texts)
        each = [self.of_word(w) for w in words.to_pylist()]
        flat = np.frombuffer(b"".join(each), np.uint32)
        size = np.array([len(x) // 4 for x in each] or [0])
        start = np.cumsum(size) - size
        for a, b in zip(bounds[:-1], bounds[1:]):
            own, n = codes[a:b], size[codes[a:b]]
            place = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.append(flat[place], np.uint32(CLOSING))


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: the id, piece, start, length and the CRC of its ids."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    arrow = pa.schema(
        [
            ("doc_id", to_arrow_type(kind)),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer_path)
        for batch in batches:
            done = 0
            for part in common.slices(batch.column(1), SLICE_BYTES):
                rows = []
                for i, ids in enumerate(tokens.of_texts(part)):
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        piece = ids[at : at + capacity].astype("<u4")
                        rows.append((done + i, n, at, len(piece), zlib.crc32(piece.tobytes())))
                whose, *columns = zip(*rows)
                names = batch.column(0).take(pa.array(whose, pa.int64()))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [names, *(pa.array(c, k) for c, k in zip(columns, arrow.types[1:]))], schema=arrow
                )
            pa.default_memory_pool().release_unused()
        del tokens
        common.release()

    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
        ]
    )
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(cut, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each length, and the number of sequences."""
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    rooms: list[int] = []  # that some open sequence has, in order
    with_room: dict[int, list[int]] = {}
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        at = bisect.bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            place = with_room[room].pop()
            if not with_room[room]:
                del rooms[at]
        else:
            room, place, n = capacity, n, n + 1
        sequence[i], offset[i] = place, capacity - room
        left = room - length
        if left:
            if not with_room.setdefault(left, []):
                bisect.insort(rooms, left)
            with_room[left].append(place)
    return sequence, offset, n


def lower_bound(lengths: np.ndarray, capacity: int) -> float:
    """The largest of the sums that two families of dual feasible functions give, in sequences."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * size)
    # Lengths under a threshold count nothing, those over the rest of a sequence count it whole.
    small = np.arange(0, capacity // 2 + 1)
    large = number[capacity] - number[capacity - small]
    below = np.where(small > 0, total[np.maximum(small - 1, 0)], 0)
    middle = total[capacity - small] - below
    best = float((large + middle / capacity).max(initial=0))
    for k in range(1, DUAL_STEPS + 1):
        steps, rest = np.divmod((k + 1) * size, capacity)
        # In units of capacity / k: whole steps keep their length, others are rounded down.
        scaled = np.where(rest == 0, k * size, steps * capacity)
        best = max(best, float((count * scaled).sum()) / (k * capacity))
    return best


def _packer(capacity: int, round_: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        sequence, offset, n = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(sequence, weights=lengths, minlength=n)
        bound = lower_bound(lengths, capacity)
        number = (round_ << 58) + (int(rows["bucket"].iloc[0]) << 20)
        return rows.drop(columns="bucket").assign(
            sequence_id=number + sequence,
            offset=offset,
            first=offset == 0,
            open=filled[sequence] < capacity,
            bound=np.where(np.arange(len(rows)) == 0, bound, 0.0),
            gap=n - bound > 1e-6,
        )

    return pack


def _deal_and_pack(pieces: DataFrame, n: int, per_partition: int, capacity: int, round_: int) -> DataFrame:
    buckets = max(1, -(-n // per_partition))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(buckets)))
    kinds = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("first", T.BooleanType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("bound", T.DoubleType()),
            T.StructField("gap", T.BooleanType()),
        ]
    )
    packed = dealt.groupBy("bucket").applyInPandas(_packer(capacity, round_), kinds)
    return common.stored(packed, f"packing-{round_}")


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PARTITION_PIECES, rounds: int = ROUNDS
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``length`` is a piece's size."""
    common.ship(pieces.sparkSession)
    columns = pieces.columns
    rows = common.stored(pieces.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    n = rows.count()
    current = _deal_and_pack(rows, n, per_partition, capacity, 0)
    done = []
    loose = F.col("gap") & F.col("open")
    for round_ in range(1, rounds + 1):
        found = current.agg(
            F.count_if("first").alias("sequences"),
            F.sum("bound").alias("bound"),
            F.count_if(loose).alias("pieces"),
            F.count_if(loose & F.col("first")).alias("open"),
        ).first()
        if not found["pieces"] or found["sequences"] <= np.ceil(found["bound"] - 1e-6):
            break
        pool = current.filter(loose)
        per_partition *= 2
        again = _deal_and_pack(pool.select(*rows.columns), found["pieces"], per_partition, capacity, round_)
        if again.filter("first").count() >= found["open"]:
            break
        done.append(current.filter(~loose))
        current = again
    for part in done:
        current = current.unionByName(part)
    return current.select(*columns, "sequence_id", "offset")
