"""Web archives: round trips, broken members, and the reader against gzip itself."""

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest

from leafline.llm import warc
from leafline.session import scratch_path

LARGE = "é<p>" * 400
ROWS = [
    (1, "http://a.net/x y\r\nEvil: 1", LARGE), (2, "http://a.net/2", LARGE), (3, None, LARGE + "z"), (4, "http://a.net/4", None),
    (5, "http://a.net/5", ""), (6, "", "short"), (7, "http://ü.net/", "short"), (None, "http://a.net/8", LARGE), (None, None, None),
    (2, "http://a.net/2", LARGE), (-3, "http://a.net/9", "x" * 1000), (9, "q", "x" * 1000), (8, "q", "y" * 999), (10, "q", "y" * 999),
    (11, "http://a.net/big", "".join(random.Random(1).choices("abcdef \n", k=3_000_000))),
]
SCHEMA = "page_id long, url string, html string"


def frame(spark, rows):
    """Pages with columns that clash with results."""
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA + ", size int, digest string, key string, error string")


def want(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            first[h] = max(i, first.get(h, i))
    out = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        to = first[h] if h in first and i != first[h] else None
        out[i, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to, None] += 1
    return out


@pytest.mark.parametrize("read,archive", [(1 << 20, 1 << 25), (7, 1), (100, 500)])
def test_round_trip(spark, monkeypatch, read, archive):
    rows = ROWS if read > 7 else ROWS[:-1]
    monkeypatch.setattr(warc, "READ_BYTES", read)
    pages = frame(spark, rows).repartition(3)
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.with_revisits(pages), path, "2024-01-01T00:00:00Z", archive)
    records = warc.read_archives(spark, path, payloads=True).collect()
    assert {r.error for r in records} == {None} and len({(r.path, r.offset) for r in records}) == len(rows)
    assert len({r.path for r in records}) >= (len(rows) if archive == 1 else 1)
    stored = Counter((r.page, r.payload.decode()) for r in records if r.type == "response")
    refers = Counter((str(i) if i is not None else None, h or "") for i, _, h in rows)
    assert stored and not stored - refers
    targets = {r.page: r.target for r in records}
    assert targets["1"] == "http://a.net/x%20y%0D%0AEvil:%201" and targets["3"] is None and targets["7"] == "http://ü.net/"
    got = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    key = lambda r: (None if r.page is None else int(r.page), r.payload_bytes, r.payload_digest, r.type, None if r.refers_to is None else int(r.refers_to), r.error)
    assert Counter(map(key, got)) == want(rows)


def test_any_tool_reads_the_archives(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.with_revisits(frame(spark, ROWS[:3]).coalesce(1)), path, "2024-01-01T00:00:00Z")
    content = spark.read.format("binaryFile").load(path).where("length > 0").first().content
    plain = gzip.decompress(content)
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: ") and plain.count(b"\r\nWARC-Record-ID: <urn:uuid:") == 3
    assert b"\r\nEvil" not in plain and content.endswith(warc.EMPTY_MEMBER) and gzip.decompress(warc.EMPTY_MEMBER) == b""


def test_pages(spark):
    got = warc.archive_pages(frame(spark, ROWS)).collect()
    assert Counter(map(tuple, got)) == want(ROWS)
    assert warc.archive_pages(frame(spark, [])).count() == 0


@pytest.mark.parametrize("crowded", [1, 2, 5000])
def test_crowded_payloads(spark, monkeypatch, crowded):
    """Whichever groups count as crowded, and however the others are joined."""
    monkeypatch.setattr(warc, "CROWDED", crowded)
    monkeypatch.setattr(warc, "broadcast_if_small", lambda df: df)
    rows = [(i, "u", LARGE) for i in range(40)] + [(100 + i, "u", LARGE + str(i // 2)) for i in range(20)] + ROWS[:-1]
    assert Counter(map(tuple, warc.archive_pages(frame(spark, rows)).collect())) == want(rows)


def response(body=b"payload", **other):
    head = warc.HTTP_HEAD.format(len(body)).encode()
    headers = {"WARC-Type": "response", "Content-Type": "application/http", "WARC-Payload-Digest": warc._sha1(body), "WARC-Block-Digest": warc._sha1(head + body), **other}
    return list(headers.items()), head + body


def errors(data, piece=1 << 20):
    warc.READ_BYTES, old = piece, warc.READ_BYTES
    try:
        return [r["error"] for r in warc.read_records(io.BytesIO(data))]
    finally:
        warc.READ_BYTES = old


@pytest.mark.parametrize("piece", [1, 3, 64, 1 << 20])
def test_broken_records(piece):
    good = warc.record(*response())
    wrong = warc.record(*response(**{"WARC-Payload-Digest": "sha1:" + "A" * 32}))
    block = warc.record(*response(**{"WARC-Block-Digest": "sha1:" + "0" * 40}))
    other = warc.record(*response(**{"WARC-Payload-Digest": "md5:x", "WARC-Block-Digest": "sha256:y"}))
    assert errors(good + wrong + warc.EMPTY_MEMBER + block + other + good, piece) == [
        None, "its payload differs from its digest", "its block differs from its digest", None, None,
    ]
    pack = lambda x: gzip.compress(x, mtime=0)
    short = pack(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")
    long = pack(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n")
    assert errors(short + long + pack(b"HTTP/1.1\r\n\r\n") + pack(b"WARC/1.0\r\nContent-Length: -1\r\n\r\n") + pack(b"WARC/1.0\r\n") + good, piece) == [
        "it is shorter than its length says", "it does not end after its block", "it does not begin as a record", "it has no length",
        "it ends in its headers", None,
    ]
    assert errors(good + good[:-9], piece) == [None, "it ends too soon"]
    assert errors(good + b"junk" + good, piece)[0] is None and "inflated" in errors(good + b"junk" + good, piece)[1]
    assert errors(b"", piece) == [] and errors(warc.EMPTY_MEMBER * 3, piece) == []
    two = warc.record(*response(b""))
    assert errors(two, piece) == [None]


def test_a_record_in_one_piece_of_memory():
    """A large record is read without holding its payload."""
    body = b"0" * 50_000_000
    data = warc.record(*response(body))
    assert len(data) < 100_000
    (got,) = warc.read_records(io.BytesIO(data))
    assert got["payload_bytes"] == len(body) and got["payload"] is None and got["error"] is None
    assert got["payload_sha1"] == hashlib.sha1(body).hexdigest() and zlib.crc32(body) == zlib.crc32(b"0" * 50_000_000)


def test_revisits_of_nothing(spark):
    path = scratch_path(spark, "archives")
    rows = [("1", "u", b"x" * 2000, "77"), ("2", "u", b"x" * 2000, None)]
    warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, payload binary, refers_to string"), path, "2024-01-01T00:00:00Z")
    got = {r.page: (r.payload_bytes, r.error) for r in warc.resolve_revisits(warc.read_archives(spark, path)).collect()}
    assert got == {"1": (None, "what it refers to is not there"), "2": (2000, None)}
