"""Documents packed into sequences that need next to no padding, by minimum bin slack.

1. Every document becomes token ids with a closing id. Documents longer than a
   sequence are cut into whole sequences and a rest, which is shorter.
2. Rests are dealt at random to windows' partitions of about ``PARTITION_PIECES``. In each
   the longest rest left opens a sequence. A dynamic programme over the distinct
   lengths left keeps the sums that can be reached as the bits of one number, and stops
   at the first length that reaches the room exactly; going back over the stored bits
   says how many pieces of each length make up the sum. A sequence closes when it is
   full. A rest that no choice fills up to the capacity is set aside.
3. What was set aside is dealt anew, as often as needed, to fewer partitions. There the
   choice with the least slack is taken, and the piece that follows is cut to fill it
   ("cut freely"), so only the last sequence of a partition stays open; its pieces go
   to the next round, until one partition is left. The tokens that this one leaves over,
   fewer than a sequence, become sequences of the powers of two that add up to them,
   which need no padding.

So no sequence is padded. Beside long documents, those are cut that a partition's first
round could not place, some 100 of its 5,000 where lengths vary (1.1 % more pieces on
the 0.5 GB of the check tool); where they do not vary, as many as the slack demands. A partition is a bounded number of rows by a hash of the
piece's own number, so no id can make it large; every round after the second leaves at
most one open sequence per partition, so their number falls by PARTITION_PIECES /
capacity at least. The driver sees one count per round.

Ids of rests are written once beside their lengths (two bytes an id), so that the CRC of
a piece that was cut later is computed from its own ids and no text is read again; they
are joined by the piece's number, which is unique.

Defined cases: a null or empty text has the closing id alone. Rows that repeat a doc_id
are packed as documents of their own. A null doc_id stays null. A long text is turned
into ids in portions that end where the tokenizer surely separates; the ids of one
document are held together (four bytes an id). Ties between lengths do not matter. An
empty table gives an empty result. Other columns of the input are not carried along.
"""

from __future__ import annotations

import json
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

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
CLOSING = 0
PARTITION_PIECES = 5_000
SLICE_BYTES = 4 << 20
CACHED_PARTS = 400_000
PORTION = 1 << 20


def part_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where texts can be cut without changing their tokens, their own bounds among them.

    Byte-level vocabularies of this kind start a new word at every white space that
    follows something else, and at every sign that follows a letter but for the
    apostrophe; the bar is left out too, as it is inside the one special token. The byte
    before a white space is asked to be a visible ASCII character or the end of a Latin
    letter, which surely is no white space.
    """
    if not len(data):
        return np.unique(bounds)
    kind = KINDS[data]
    latin = data[:-1] == 0xC3
    solid = (kind[:-1] & SOLID) != 0
    solid[1:] |= latin[:-1]
    letter = (kind[:-1] & LETTER) != 0
    inner = ((kind[1:] & BLANK) != 0) & solid | ((kind[1:] & SIGN) != 0) & letter
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = inner
    cut[bounds] = True
    return np.flatnonzero(cut)


BLANK, SOLID, LETTER, SIGN = 1, 2, 4, 8
KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \n\t\r")] = BLANK
KINDS[33:127] = SOLID
for _first, _last in (b"AZ", b"az"):
    KINDS[_first : _last + 1] |= LETTER
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'|"]] |= SIGN

# One word in the tokenizer's sense: a blank perhaps, and Latin letters or signs.
PLAIN = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\[-`{}~]+)")


def _byte_letters() -> dict[int, str]:
    """The usual rule by which byte-level vocabularies write bytes as letters."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _merges(path: str):
    """The merges of one word in a library that is faster word by word, or None.

    It merges the pair whose result has the lowest id first, which is the file's own
    order where results are numbered as the merges are listed.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    back = {letter: byte for byte, letter in _byte_letters().items()}
    vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if [vocabulary.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {bytes(map(back.__getitem__, token)): i for token, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe


class Tokens:
    """Ids of parts of texts as bytes; parts seen lately are kept, at most ``CACHED_PARTS``."""

    LETTERS = _byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.merges = _merges(path)

    @property
    def id_type(self) -> str:
        return "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def _of_part(self, part: str) -> bytes:
        body = part[1:] if part[0] == " " else part
        if body.isascii() and body.isalpha() or PLAIN.fullmatch(part):
            data = part.encode()
            if self.merges is not None:
                return array("I", self.merges.encode_single_piece(data)).tobytes()
            shown = "".join(map(self.LETTERS.__getitem__, data))
            return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > CACHED_PARTS:
            known.clear()
        out = []
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = known[part] = self._of_part(part)
            out.append(ids)
        return out

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text and the closing id."""
        data, bounds = common.bytes_of(texts)
        cuts = part_bounds(data, bounds)
        runs = [self._of_run(data, cuts[at : at + PORTION + 1]) for at in range(0, len(cuts) - 1, PORTION)]
        ids = np.concatenate([x for x, _ in runs]) if runs else np.empty(0, np.uint32)
        ends = np.cumsum(np.concatenate([[0], *(n for _, n in runs)]))[np.searchsorted(cuts, bounds)]
        for a, b in zip(ends[:-1], ends[1:]):
            yield np.append(ids[a:b], np.uint32(CLOSING))

    def _of_run(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive parts, and how many each has."""
        text = data[cuts[0] : cuts[-1]]
        parts = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts - cuts[0]), pa.py_buffer(text))
        coded = parts.dictionary_encode()
        each = self._of_parts(coded.dictionary.to_pylist())
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])])
        own = pa.LargeListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(each), np.uint32)))
        found = own.take(coded.indices)
        return found.flatten().to_numpy(), np.diff(found.offsets.to_numpy())


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece of a document, cut only where it is longer than a sequence.

    ``ids`` holds the ids of pieces shorter than a sequence, as bytes of ``id_bytes`` each.
    """
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    numbers = ("start", "length", "ids_crc32", "doc_tokens")
    arrow = pa.schema(
        [("doc_id", to_arrow_type(kind)), *((c, pa.int64()) for c in numbers), ("id_bytes", pa.int32()), ("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer_path)
        held = np.dtype(tokens.id_type)
        for batch in batches:
            done = 0
            for part in common.slices(batch.column(1), SLICE_BYTES):
                whose, rows = [], []
                for i, ids in enumerate(tokens.of_texts(part)):
                    for at in range(0, len(ids), capacity):
                        piece = ids[at : at + capacity]
                        own = piece.astype(held).tobytes() if len(piece) < capacity else None
                        whose.append(done + i)
                        rows.append((at, len(piece), crc_of(piece), len(ids), held.itemsize, own))
                names = batch.column(0).take(pa.array(whose, pa.int64()))
                done += len(part)
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), arrow.types[1:])]
                yield pa.RecordBatch.from_arrays([names, *columns], schema=arrow)
            pa.default_memory_pool().release_unused()

    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            *(T.StructField(c, T.LongType()) for c in numbers),
            T.StructField("id_bytes", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(cut, schema)


def fill(counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum of lengths that is at most ``room``, and how many of each make it up.

    ``counts`` has how many pieces of each length there are. Bit s of a number says
    that sum s can be reached with the lengths seen so far.
    """
    within = (2 << room) - 1
    reached = [1]
    lengths = []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        bits, left, step = reached[-1], min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... and the rest add up to every count
            take = min(step, left)
            bits |= (bits << take * length) & within
            left -= take
            step *= 2
        lengths.append(length)
        reached.append(bits)
        if bits >> room:
            break
    total = rest = reached[-1].bit_length() - 1
    taken = {}
    for length, before in zip(reversed(lengths), reversed(reached[:-1])):
        n = 0
        while not before >> rest & 1:
            rest -= length
            n += 1
        if n:
            taken[length] = n
    return total, taken


class Packer:
    """Pieces of one partition, by length; fills one sequence after the other."""

    def __init__(self, pieces: list[tuple[int, int, int]], capacity: int):
        self.capacity = capacity
        self.by_length: dict[int, list[tuple[int, int, int]]] = {}
        for piece in pieces:
            self._add(piece)
        #: (piece, start, length, sequence or None, offset)
        self.placed: list[tuple[int, int, int, int | None, int]] = []
        self.sequences = 0

    def _add(self, piece: tuple[int, int, int]) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)

    def _pop(self, length: int) -> tuple[int, int, int]:
        own = self.by_length[length]
        piece = own.pop()
        if not own:
            del self.by_length[length]
        return piece

    def _close(self, pieces: list[tuple[int, int, int]]) -> None:
        offset = 0
        for piece in pieces:
            self.placed.append((*piece, self.sequences, offset))
            offset += piece[2]
        self.sequences += 1

    def _aside(self, pieces: list[tuple[int, int, int]]) -> None:
        self.placed += [(*piece, None, 0) for piece in pieces]

    def _cut(self, length: int) -> tuple[int, int, int]:
        """The first ids of the shortest piece that is longer; the others stay."""
        number, start, size = self._pop(min(x for x in self.by_length if x > length))
        self._add((number, start + length, size - length))
        return number, start, length

    def pack(self, cutting: bool, last: bool) -> None:
        while self.by_length:
            longest = max(self.by_length)
            chosen = [self._pop(longest)]
            total, taken = fill({n: len(p) for n, p in self.by_length.items()}, self.capacity - longest)
            room = self.capacity - longest - total
            if room and not cutting:
                self._aside(chosen)
                continue
            chosen += [self._pop(n) for n, times in taken.items() for _ in range(times)]
            if room and self.by_length:  # none of the others fits, so each is longer than the room
                chosen.append(self._cut(room))
                room = 0
            if not room:
                self._close(chosen)
            elif last:
                self._powers(chosen)
            else:
                self._aside(chosen)

    def _powers(self, pieces: list[tuple[int, int, int]]) -> None:
        pieces = pieces[::-1]
        total = sum(p[2] for p in pieces)
        for bit in range(total.bit_length() - 1, -1, -1):
            room, chosen = total & 1 << bit, []
            while room:
                number, start, length = pieces.pop()
                chosen.append((number, start, min(room, length)))
                if length > room:
                    pieces.append((number, start + room, length - room))
                room -= chosen[-1][2]
            if chosen:
                self._close(chosen)


ROWS = "piece long, start long, length long"
PLACED = f"{ROWS}, sequence_id long, offset long"


def _solver(capacity: int, round_: int, last: bool):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(list(zip(rows["piece"].tolist(), rows["start"].tolist(), rows["length"].tolist())), capacity)
        packer.pack(cutting=round_ > 0, last=last)
        number = (round_ << 58) + (int(rows["bucket"].iloc[0]) << 20)
        columns = list(zip(*packer.placed))
        sequence = pd.array([None if s is None else number + s for s in columns[3]], "Int64")
        return pd.DataFrame(
            {"piece": columns[0], "start": columns[1], "length": columns[2], "sequence_id": sequence, "offset": columns[4]}
        )

    return solve


def _crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CRC of the ids from ``start`` on, where ``first`` is the place of the first of ``ids``."""
    for batch in batches:
        rows = batch.select(["start", "length", "first", "id_bytes", "ids"]).to_pylist()
        crcs = []
        for r in rows:
            ids, at = np.frombuffer(r["ids"], f"<u{r['id_bytes']}"), r["start"] - r["first"]
            crcs.append(crc_of(ids[at : at + r["length"]]))
        kept = [batch.column(c) for c in ("doc_id", "start", "length")]
        rest = [batch.column(c) for c in ("doc_tokens", "sequence_id", "offset")]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(crcs, pa.int64()), *rest], names=names)


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PARTITION_PIECES) -> DataFrame:
    """Pieces as ``token_pieces`` makes them, cut further where needed, with their places."""
    common.ship(pieces.sparkSession)
    if per_partition < 2 * capacity:
        raise ValueError("a partition takes at least two sequences of the smallest pieces")
    numbered = common.stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "slack-pieces")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = numbered.filter(F.col("length") == capacity)
    whole = whole.select(*out[:5], (-1 - F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = numbered.filter(F.col("length") < capacity).select("piece", "start", "length")
    placed, round_ = [], 0
    while n := pool.count():
        buckets = -(-n // per_partition)
        last = buckets == 1 and round_ > 0
        dealt = pool.withColumn("bucket", F.pmod(F.xxhash64("piece", "start", F.lit(round_)), F.lit(buckets)))
        solved = dealt.groupBy("bucket").applyInPandas(_solver(capacity, round_, last), PLACED)
        solved = common.stored(solved, f"slack-packing-{round_}")
        placed.append(solved.filter("sequence_id IS NOT NULL"))
        pool = solved.filter("sequence_id IS NULL").select("piece", "start", "length")
        round_ += 1
    if not placed:
        return whole
    places = placed[0]
    for more in placed[1:]:
        places = places.unionByName(more)
    # The ids themselves are read for the pieces that were cut, and for no others.
    rests = numbered.filter(F.col("length") < capacity)
    ends = rests.select("piece", "doc_id", "doc_tokens", "ids_crc32", F.col("start").alias("first"), F.col("length").alias("size"))
    found = places.join(ends, "piece")
    uncut = found.filter(F.col("length") == F.col("size")).select(*out)
    cut = found.filter(F.col("length") < F.col("size")).drop("ids_crc32", "size")
    cut = cut.join(rests.select("piece", "id_bytes", "ids"), "piece")
    schema = T.StructType([whole.schema[c] for c in out])
    return whole.unionByName(uncut).unionByName(cut.mapInArrow(_crcs, schema))
