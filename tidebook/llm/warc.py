"""WARC archives: a writer, and a sequential reader.

The writer puts each record into a gzip member of its own and starts a new
archive after ``archive_bytes``. The reader streams an archive: it inflates
member by member, takes a record's block by its Content-Length, and checks the
block's and the payload's digest while it reads; memory holds a chunk and a
record's headers, whatever the sizes.

Archives are written to the given folder through pyarrow's file systems, from
the executors. A task that is run again writes new files; only files named in
the manifest, which Spark commits with the finished tasks, belong to the result.

Of records with equal payloads, the one with the largest id is a ``response``;
the others are ``revisit`` records without payload that refer to it.

Defined cases: a null payload counts as empty. A record with a null id is
written and read with a null id; it is the response of its payload only where
no other id has it. Rows that repeat the largest id are all responses. A null
url leaves the target out. The writer holds a payload and its compressed member in
memory, a few times its size; the reader streams. An empty table gives no archive and an
empty result.
Other columns of the input are not part of an archive.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import partitions, ship, stored, text_or_empty

ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 20
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "path string, records long, archive_bytes long"
RECORDS = (
    "record_id long, target_uri string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-row:"


def with_roles(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """Rows of (id, uri, payload, digest) with the id that holds an equal payload.

    Digests that occur once need no role, so only repeated ones are joined; the
    written table has a known size, by which Spark broadcasts or shuffles it.
    """
    digest = F.sha1(F.encode(F.col("payload"), "UTF-8"))
    rows = pages.withColumn("payload", text_or_empty(payload_col)).withColumn("digest", digest)
    sized = rows.filter(F.octet_length("payload") >= min_bytes)
    repeated = (
        sized.groupBy("digest")
        .agg(F.max(id_col).alias("holder"), F.count("*").alias("copies"))
        .filter("copies > 1 AND holder IS NOT NULL")
        .drop("copies")
    )
    joined = rows.join(stored(repeated, "warc-holders"), "digest", "left")
    return joined.withColumn("holder", F.when(F.octet_length("payload") >= min_bytes, F.col("holder")))


def _uri(value: str) -> str:
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~")


def record(row_id: int | None, url: str | None, payload: bytes, digest: str, holder: int | None) -> bytes:
    """One uncompressed record; ``holder``: the id of the response that it revisits."""
    revisit = holder is not None and holder != row_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: <{URN}{'null' if row_id is None else row_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{holder}>"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{block_digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        stream, path, records, size = None, "", 0, 0

        def closed():
            stream.close()
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": [records], "archive_bytes": [size]}
            )

        for batch in batches:
            for row_id, url, payload, digest, holder in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, records, size = f"{folder}/{name}", 0, 0
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                name32 = base64.b32encode(bytes.fromhex(digest)).decode()
                data = member(record(row_id, url, payload.encode(), name32, holder))
                stream.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    return write


def folder_uri(folder: str) -> str:
    return folder if re.match(r"\w+:/", folder) else f"file://{os.path.abspath(folder)}"


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write all rows as archives into a shared ``folder``; the manifest of what was written."""
    ship(pages.sparkSession)
    pages = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).alias("raw"),
    )
    rows = with_roles(pages, "id", "raw", min_bytes).select("id", "url", "payload", "digest", "holder")
    return stored(rows.mapInArrow(_writer(folder_uri(folder), archive_bytes), MANIFEST), "warc-manifest")


class Members:
    """The bytes inside consecutive gzip members, inflated as they are asked for."""

    def __init__(self, stream):
        self.stream, self.packed, self.plain = stream, b"", b""
        self.inflater = zlib.decompressobj(31)

    def more(self) -> bool:
        """Inflate a further chunk of this member; False at its end."""
        while not self.inflater.eof:
            self.packed = self.packed or self.stream.read(CHUNK)
            if not self.packed:
                raise ValueError("an archive ends within a member")
            data = self.inflater.decompress(self.packed, CHUNK)
            self.packed = self.inflater.unconsumed_tail or self.inflater.unused_data
            if data:
                self.plain += data
                return True
        return False

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        self.packed = self.packed or self.stream.read(CHUNK)
        self.inflater, self.plain = zlib.decompressobj(31), b""
        return bool(self.packed)

    def until(self, mark: bytes) -> bytes:
        while (at := self.plain.find(mark)) < 0:
            if not self.more():
                raise ValueError("a record ends within its headers")
        found, self.plain = self.plain[:at], self.plain[at + len(mark) :]
        return found

    def exactly(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.plain and not self.more():
                raise ValueError("a record is shorter than its Content-Length")
            found, self.plain = self.plain[:size], self.plain[size:]
            size -= len(found)
            yield found


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _row_id(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?\d+)>", value or "")
    return int(found[1]) if found else None


def records_of(stream) -> Iterator[tuple]:
    """All records of an archive; a wrong digest or length raises."""
    members = Members(stream)
    while members.next_member():
        head = _fields(members.until(b"\r\n\r\n"))
        block, payload, size = hashlib.sha1(), hashlib.sha1(), 0
        http, open_head = b"", True
        for chunk in members.exactly(int(head["content-length"])):
            block.update(chunk)
            if open_head:
                http, mark, rest = (http + chunk).partition(b"\r\n\r\n")
                open_head = not mark
                http, chunk = (http, rest) if mark else (http + rest, b"")
            payload.update(chunk)
            size += len(chunk)
        if b"".join(members.exactly(4)) != b"\r\n\r\n" or members.plain or members.more():
            raise ValueError("a record does not end where its Content-Length says")
        stated = head["warc-payload-digest"].removeprefix("sha1:")
        length = int(_fields(http).get("content-length", size))
        found = [(block, head["warc-block-digest"].removeprefix("sha1:"))]
        if head["warc-type"] == "response":
            found.append((payload, stated))
            if size != length:
                raise ValueError("a payload is not as long as its header says")
        for digest, expected in found:
            if base64.b32encode(digest.digest()).decode() != expected:
                raise ValueError(f"wrong digest in {head['warc-record-id']}")
        yield (
            _row_id(head["warc-record-id"]),
            head.get("warc-target-uri"),
            length,
            stated,
            head["warc-type"],
            _row_id(head.get("warc-refers-to")),
        )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, place = fs.FileSystem.from_uri(path)
            with store.open_input_stream(place, compression=None) as stream:
                rows = []
                for row in records_of(stream):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that a manifest names; an archive is read by one task."""
    ship(manifest.sparkSession)
    paths = manifest.select("path").repartition(partitions(manifest.sparkSession), "path")
    return paths.mapInArrow(_reader, RECORDS)
