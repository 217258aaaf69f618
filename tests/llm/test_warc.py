from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections import defaultdict

import pytest

from tidebook.llm import warc
from tidebook.llm.common import scratch

ROWS = [
    (1, "http://a.example/é\r\nX: y", "<p>one</p>"),
    (2, None, None),
    (3, "", ""),
    (4, "http://b/", "same"),
    (9, "http://c/", "same"),
    (9, "http://c/", "same"),
    (None, "http://d/", "same"),
    (None, "http://e/", "only null"),
    (5, "http://f/", "\r\n\r\nü" * 700_000),
    (6, "http://g/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
] + [(100 + i, f"http://h/{i}", f"copy {i % 3}") for i in range(60)]


def pages(spark, rows):
    schema = "page_id long, url string, html string, digest string, holder long, path string"
    return spark.createDataFrame([(*r, "x", 1, "p") for r in rows], schema)


def expected(rows, least):
    by = defaultdict(list)
    for i, _, h in rows:
        by[h or ""].append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        holder = max((x for x in by[h or ""] if x is not None), default=None)
        revisit = len(data) >= least and len(by[h or ""]) > 1 and holder is not None and i != holder
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", holder if revisit else None))
    return sorted(out, key=repr)


def found(manifest):
    rows = warc.read_warc(manifest).collect()
    return sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)


@pytest.mark.parametrize(("least", "size"), [(0, 1 << 30), (5, 2_000)])
def test_round_trip(spark, least, size):
    folder = scratch(spark, "warc")
    manifest = warc.write_warc(pages(spark, ROWS), folder, min_bytes=least, archive_bytes=size)
    assert found(manifest) == expected(ROWS, least)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)


def test_empty_table(spark):
    manifest = warc.write_warc(pages(spark, []), scratch(spark, "warc"))
    assert manifest.count() == 0 and found(manifest) == []


def test_one_member_per_record():
    records = [warc.record(i, "http://a/", b"x" * i, "AA", None) for i in range(3)]
    data = b"".join(map(warc.member, records))
    assert gzip.decompress(data) == b"".join(records)
    for record in records:
        unpacker = zlib.decompressobj(31)
        assert unpacker.decompress(data) == record
        data = unpacker.unused_data


@pytest.mark.parametrize("change", [lambda r: r.replace(b"payload", b"paYload", 1), lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1), lambda r: r[:-6]])
def test_damage_is_found(change):
    digest = base64.b32encode(hashlib.sha1(b"payload").digest()).decode()
    record = warc.record(1, "http://a/", b"payload", digest, None)
    assert len(list(warc.records_of(io.BytesIO(warc.member(record))))) == 1
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(warc.member(change(record)))))
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(warc.member(record)[:-20])))
