"""Web archives: pages written as records, one gzip member each, and read back.

An archive is a file of records after one another. A response record holds an
HTTP answer with its payload; a revisit record names the response record whose
payload it repeats.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.text import chunks
from leafline.session import broadcast_if_small, materialize, scratch_path

#: payloads of fewer bytes are always stored
LEAST_REVISIT = 1000
#: an archive ends with the record that brings it to so many bytes
ARCHIVE_BYTES = 32 << 20
#: bytes that are inflated at a time (what is left of them is copied for each
#: member), and bytes that are fetched from a file, or sent on, at a time
READ_BYTES, BUFFER_BYTES = 1 << 16, 1 << 20
#: bytes of headers that a record may have
HEADER_BYTES = 1 << 20
#: groups of equal payloads that hold more than this part of all rows, fewer than
#: so many, are broadcast
CROWDED = 5000

# The words of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: a gzip member of nothing; the text sink puts it behind each archive
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header's value on one line: what would break it is percent-encoded."""
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record_id(page: str | None, target: str | None, digest: str) -> str:
    """The same row has the same id whenever its task runs."""
    h = hashlib.sha256(repr((page, target, digest)).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}>"


def record(headers: list[tuple[str, str | None]], block: bytes, level: int = 6) -> bytes:
    """A record as one gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None)
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_record(page: str | None, target: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """The record of a page: a response, or a revisit of page `refers_to`."""
    digest, target = _sha1(payload), None if target is None else _clean(target)
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if refers_to is not None else head + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page, target, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Profile", None if refers_to is None else PROFILE), ("Content-Type", "application/http;msgtype=response"),
        ("Page-Id", page), ("Refers-To-Page-Id", refers_to),
    ]
    return record(headers, block)


def with_revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, refers_to) for every row of `pages`: of rows with
    equal payloads of at least `least` bytes that with the largest page_id has no
    refers_to, the others have its id; null ids come last.

    Payloads are told apart by length and SHA-256, summed in each task first, so
    what is shuffled is one row for each payload and task. The few payloads that
    are repeated are joined back: those of a crowded group always by broadcast (at
    most CROWDED of them hold more than one CROWDEDth of all rows), the others too if they are
    few, else by a shuffle in which no key has many rows."""
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")
    )
    large = F.octet_length("payload") >= least
    rows = rows.withColumn("digest", F.when(large, F.unhex(F.sha2("payload", 256))))
    groups = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("size"))
    groups = materialize(groups.where("size > 1 and first is not null"), "payloads")
    total = groups.agg(F.sum("size")).first()[0] or 0
    crowded = F.col("size") * CROWDED > total
    hot = groups.where(crowded).select("digest", F.col("first").alias("hot_first"))
    cold = groups.where(~crowded).select(F.col("digest").alias("key"), "first")
    found = rows.join(F.broadcast(hot), "digest", "left")
    # rows that are settled, or alone, look for a key of their own, so none is crowded
    own = F.unhex(F.sha2(F.concat_ws(" ", F.col("page_id").cast("string"), F.xxhash64("url", "digest").cast("string")), 224))
    found = found.withColumn("key", F.when(F.col("hot_first").isNull() & F.col("digest").isNotNull(), F.col("digest")).otherwise(own))
    found = found.join(broadcast_if_small(cold), "key", "left")
    first = F.coalesce("hot_first", "first")
    return found.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(first), first).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, date: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for every row of `pages` (page_id, url, payload, refers_to)
    as archives under `path`; a row with `refers_to` becomes a revisit record,
    whose payload is not stored. Each archive is one row of the text sink, in a
    file of its own, so a lost task leaves nothing half written."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in chunks(batches, "payload"):
            columns = (b.column(n) for n in ("page", "url", "payload", "refers_to"))
            for page, url, payload, refers_to in zip(*columns):
                held.append(page_record(page.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    slim = pages.select(
        F.col("page_id").cast("string").alias("page"), F.col("url").cast("string").alias("url"), "payload",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    packed = slim.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = packed.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
    writer.option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class _Member:
    """What one gzip member says, read piece by piece: headers, then a block of
    the length they give, then two line ends."""

    def __init__(self, keep: bool):
        self.keep, self.head, self.headers, self.error = keep, b"", None, None
        self.left, self.tail, self.inner = 0, b"", b""
        self.block, self.payload, self.size, self.parts = hashlib.sha1(), hashlib.sha1(), 0, []
        self.in_http = False

    def feed(self, data: bytes) -> None:
        if self.error:
            return
        if self.headers is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                self.error = "its headers are too long" if len(self.head) > HEADER_BYTES else None
                return
            lines, data = self.head[:end].decode("utf-8", "replace").split("\r\n"), self.head[end + 4 :]
            self.head = b""
            self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            if not lines[0].startswith("WARC/"):
                self.error = "it does not begin as a record"
                return
            length = self.headers.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                self.error = "it has no length"
                return
            self.left = int(length)
            self.in_http = self.headers.get("content-type", "").startswith("application/http")
        body, rest = data[: self.left], data[self.left :]
        self.left -= len(body)
        self.block.update(body)
        if self.in_http:
            self.inner += body
            end = self.inner.find(b"\r\n\r\n")
            if end < 0:
                self.error = "its HTTP headers are too long" if len(self.inner) > HEADER_BYTES else None
                body = b""
            else:
                body, self.inner, self.in_http = self.inner[end + 4 :], b"", False
        self.payload.update(body)
        self.size += len(body)
        if self.keep:
            self.parts.append(body)
        self.tail += rest[: 5 - len(self.tail)]

    def fault(self) -> str | None:
        """What is wrong with the whole member, if anything."""
        if self.error or self.headers is None:
            return self.error or "it ends in its headers"
        if self.left:
            return "it is shorter than its length says"
        if self.tail != b"\r\n\r\n":
            return "it does not end after its block"
        if self.in_http:
            return "it ends in its HTTP headers"
        told = self.headers.get("warc-block-digest")
        if told is not None and not _same_digest(told, self.block.digest()):
            return "its block differs from its digest"
        told = self.headers.get("warc-payload-digest")
        if told is not None and self.headers.get("warc-type") != "revisit" and not _same_digest(told, self.payload.digest()):
            return "its payload differs from its digest"
        return None


def _same_digest(told: str, digest: bytes) -> bool:
    """False for another SHA-1 digest, in base 32 or hexadecimal; digests of other kinds are not judged."""
    kind, _, value = told.partition(":")
    return kind.lower() != "sha1" or value.upper() == base64.b32encode(digest).decode() or value.lower() == digest.hex()


def _hex(told: str | None) -> str | None:
    """A `sha1:` digest in lower-case hexadecimal."""
    kind, _, value = (told or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def read_records(stream, keep: bool = False) -> Iterator[dict]:
    """The records of an archive, in order, from a stream that is read forward
    only. Members are inflated piece by piece; besides a piece, a record's headers
    (and with `keep` its payload) are all that is held. Empty members are passed
    over. A record that is not as it says comes with an `error`; after a member
    that cannot be inflated, or that ends too soon, nothing more is read."""
    offset, data = 0, stream.read(READ_BYTES)
    while data:
        unpack, member, used, broken = zlib.decompressobj(31), _Member(keep), 0, None
        some = False
        while True:
            try:
                out = unpack.decompress(data, READ_BYTES)
            except zlib.error as e:
                broken = f"it cannot be inflated: {e}"
                break
            some = some or bool(out)
            member.feed(out)
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            used += len(data) - len(left)
            data = left
            if unpack.eof:
                break
            if not data:
                data = stream.read(READ_BYTES)
                if not data and not out:
                    broken = "it ends too soon"
                    break
        if some or broken:
            h = member.headers or {}
            yield {
                "offset": offset, "headers": h, "error": broken or member.fault(), "payload_bytes": member.size,
                "payload_sha1": member.payload.hexdigest(), "payload": b"".join(member.parts) if keep else None,
            }
        if broken:
            return
        offset += used
        data = data or stream.read(READ_BYTES)


RECORD = (
    "path string, offset long, type string, record_id string, target string, page string, refers_to string, "
    "payload_bytes long, payload_digest string, headers map<string, string>, error string, payload binary"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row for each record of the archives under `path`, in the columns of
    RECORD. Payload bytes and digest (SHA-1, hexadecimal) are those of what is
    read; a revisit has the digest it names and no bytes, as its payload is
    elsewhere (see `resolve_revisits`). `error` says what is wrong with a
    broken record; sound ones have none. `payload` is null unless `payloads`.

    Archives are dealt out to tasks, and each is read forward once, a piece at a
    time, so neither its length nor a record's matters."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    tasks = max(1, min(files.count(), 4 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORD.replace("map<string, string>", "map").split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for uri in b.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(uri)
                rows, size = [], 0
                with system.open_input_stream(place, compression=None, buffer_size=BUFFER_BYTES) as stream:
                    for r in read_records(stream, payloads):
                        h = r["headers"]
                        revisit = h.get("warc-type") == "revisit"
                        rows.append((
                            uri, r["offset"], h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("page-id"),
                            h.get("refers-to-page-id"), None if revisit else r["payload_bytes"],
                            _hex(h.get("warc-payload-digest")) if revisit else r["payload_sha1"], list(h.items()), r["error"], r["payload"],
                        ))
                        size += len(r["payload"] or b"") + 1000
                        if size >= BUFFER_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return files.select("path").repartition(tasks, "path").mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """`records` with the payload bytes of what each revisit refers to: the
    response of that page with the same digest. A revisit without one has an
    error. Responses that are referred to are found by digest first, so what is
    looked up is no more than there are repeated payloads; crowded ones are
    broadcast, as in `with_revisits`."""
    revisit = F.col("type") == "revisit"
    asked = records.where(revisit).groupBy("refers_to", "payload_digest").agg(F.count("*").alias("size"))
    asked = asked.withColumnsRenamed({"refers_to": "r", "payload_digest": "d"})
    sound = records.where((F.col("type") == "response") & F.col("error").isNull())
    given = sound.groupBy(F.col("page").alias("r"), F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("n"))
    known = materialize(asked.join(given, ["r", "d"]), "referred")
    total = known.agg(F.sum("size")).first()[0] or 0
    crowded = F.col("size") * CROWDED > total
    match = (F.col("refers_to") == F.col("r")) & (F.col("payload_digest") == F.col("d"))
    hot = known.where(crowded).select("r", "d", F.col("n").alias("hot_n"))
    out = records.join(F.broadcast(hot), match & revisit, "left").drop("r", "d")
    own = F.concat_ws(" ", "path", F.col("offset").cast("string"))
    key = F.when(revisit & F.col("hot_n").isNull(), F.concat_ws(" ", "refers_to", "payload_digest")).otherwise(own)
    cold = known.where(~crowded).select(F.concat_ws(" ", "r", "d").alias("key"), "n")
    out = out.withColumn("key", key).join(broadcast_if_small(cold), "key", "left")
    size = F.coalesce("hot_n", "n")
    lost = revisit & size.isNull() & F.col("error").isNull()
    return out.withColumns({
        "payload_bytes": F.when(revisit, size).otherwise(F.col("payload_bytes")),
        "error": F.when(lost, "what it refers to is not there").otherwise(F.col("error")),
    }).drop("key", "hot_n", "n")


def archive_pages(pages: DataFrame, page_id: str = "page_id", payload: str = "html", date: str = "2024-01-01T00:00:00Z", path: str | None = None) -> DataFrame:
    """Write the rows of `pages` (page_id, url, payload) as archives and read them
    back: (page_id, payload_bytes, payload_digest, record_type, refers_to, error)
    for every row, from the archives alone.

    A null payload counts as empty; a null url or page_id leaves its header out.
    Rows of one page_id are records like others; of several rows with the largest
    id of a payload all are responses. Other columns are not looked at; no rows
    give no rows. Without `path` the archives go to the shared folder."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(with_revisits(pages, page_id, payload), path, date)
    kind = pages.schema[page_id].dataType
    records = materialize(read_archives(spark, path).drop("payload", "headers"), "records")
    found = resolve_revisits(records)
    return found.select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"), "error",
    )
