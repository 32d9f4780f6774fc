"""Document lengths in flat token files without an index.

A file is a row of little-endian 32-bit token ids. Each document is `header`
tokens that hold its id, its tokens, and the end-of-document id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafline.llm.text import chunks, words

WIDTH = 4
END = 0
#: tokens that hold a document's id: 31 bits each, plus 1, so that none is END
HEADER = 3
#: bytes of a file that a task reads at a time
BLOCK = 8 << 20
#: blocks of a file that are scanned in one task before their totals are
GROUP = 1024


def token_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit id, never END, for each word of the texts, and the offsets of
    the texts. Ids are checksums of words; no vocabulary is needed."""
    flat, offsets = words(texts)
    coded = flat.dictionary_encode()
    ids = np.array([zlib.crc32(w.encode()) for w in coded.dictionary.to_pylist()], np.uint32)
    ids = (ids % np.uint32(0xFFFFFFFF)) + np.uint32(1)
    return (ids[coded.indices.to_numpy(zero_copy_only=False)] if len(ids) else ids), offsets


def write_token_files(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the tokens of all rows as flat files under `path`, one per task.
    The text sink writes each row's bytes and a line separator, and the
    separator is the end-of-document token itself."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            ids, offsets = token_ids(b.column("text"))
            # a null id has the header of the least number, which no table can hold besides
            doc = b.column("doc_id").fill_null(-(1 << 63)).to_numpy().astype(np.int64).view(np.uint64)
            lengths = np.diff(offsets) + HEADER
            ends = np.concatenate([[0], np.cumsum(lengths)])
            out = np.empty(int(ends[-1]), np.uint32)
            body = np.ones(len(out), bool)
            for k in range(HEADER):
                at = ends[:-1] + k
                out[at] = ((doc >> np.uint64(31 * k)) & np.uint64(0x7FFFFFFF)).astype(np.uint32) + np.uint32(1)
                body[at] = False
            out[body] = ids
            buffers = [None, pa.py_buffer((ends * WIDTH).astype(np.int32)), pa.py_buffer(out.astype("<u4"))]
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), b.num_rows, buffers)], ["value"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    encoded = slim.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    encoded.write.option("lineSep", "\0" * WIDTH).text(path)


def _read(uri: str, start: int, length: int) -> np.ndarray:
    """Tokens of one range of a file, from any file system that Arrow opens."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read_at(length, start), "<u4")


def _header_id(tokens: np.ndarray) -> int | None:
    value = sum((int(t) - 1) << (31 * k) for k, t in enumerate(tokens[:HEADER])) & ((1 << 64) - 1)
    value -= (value >> 63) << 64
    return None if value == -(1 << 63) else value


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows for each block. Whole documents, which begin and end in
    it: doc_id, n_tokens. The block itself: its tokens, where its first document
    ends and where its last one begins (null without an end), and the ids that
    begin at its first and its last start. Headers may run on into the next
    block, so a few tokens more are read."""
    names = ["path", "block", "tokens", "first_end", "open_at", "open_id", "doc_id", "n_tokens"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for b in batches:
        for path, block, start, length in zip(*(b.column(n).to_pylist() for n in ("path", "block", "start", "length"))):
            tokens = _read(path, start, length + HEADER * WIDTH)
            own = tokens[: length // WIDTH]
            ends = np.flatnonzero(own == END)
            inner = ends[:-1] + 1  # starts of documents that also end here
            heads = np.stack([tokens[inner + k].astype(np.uint64) - np.uint64(1) for k in range(HEADER)]) if len(inner) else None
            ids, sizes = [], []
            if heads is not None:
                value = (heads[0] | heads[1] << np.uint64(31) | heads[2] << np.uint64(62)).view(np.int64)
                ids = [None if v == -(1 << 63) else v for v in value.tolist()]
                sizes = (np.diff(ends) - 1 - HEADER).tolist()
            opens = int(ends[-1]) + 1 if len(ends) else None
            open_id = _header_id(tokens[opens:]) if opens is not None and len(tokens) >= opens + HEADER else None
            n = len(ids) + 1
            columns = [
                [path] * n, [block] * n, [len(own)] + [None] * len(ids), [int(ends[0]) if len(ends) else None] + [None] * len(ids),
                [opens] + [None] * len(ids), [open_id] + [None] * len(ids), [None, *ids], [None, *sizes],
            ]
            if block == 0:  # the file's first document opens before any end
                columns = [[c[0], *c] for c in columns]
                for c, v in zip(columns, (path, -1, 0, None, 0, _header_id(tokens) if len(tokens) >= HEADER else None, None, None)):
                    c[0] = v
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def count_tokens(spark: SparkSession, path: str, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(doc_id, n_tokens) of every document in the flat token files under `path`.

    Blocks of all files are dealt out evenly and searched side by side. A
    document that runs over block edges is put together from the blocks' few
    numbers: a prefix scan carries where the last document began from block to
    block, first within groups of blocks, then over the groups' totals, so a
    file of any length meets in no task. A document of many blocks, files of
    no document, null and repeated ids and documents without tokens all come out
    right; tokens after a file's last end are no document."""
    if block % WIDTH:
        raise ValueError("a block must hold whole tokens")
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.expr(f"(length - 1) div {block}"))).alias("block"))
    blocks = blocks.select("path", "block", (F.col("block") * block).alias("start"), F.least(F.lit(block), F.col("length") - F.col("block") * block).alias("length"))
    tasks = max(1, min(blocks.count(), 4 * spark.sparkContext.defaultParallelism))
    schema = "path string, block long, tokens long, first_end long, open_at long, open_id long, doc_id long, n_tokens long"
    from leafline.session import materialize

    scanned = materialize(blocks.repartition(tasks, "path", "block").mapInArrow(_scan, schema), "token-blocks")
    whole = scanned.where("n_tokens is not null").select("doc_id", "n_tokens")
    edge = scanned.where("tokens is not null").withColumn("g", F.floor(F.col("block") / group))
    opened = F.when(F.col("open_at").isNotNull(), F.struct((F.col("p") + F.col("open_at")).alias("at"), F.col("open_id").alias("id")))
    # totals of the groups, then of each block within its group
    sums = edge.groupBy("path", "g").agg(F.sum("tokens").alias("t"))
    before_group = Window.partitionBy("path").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("path", "g", F.coalesce(F.sum("t").over(before_group), F.lit(0)).alias("base"))
    within = Window.partitionBy("path", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.join(sums, ["path", "g"]).withColumn("p", F.col("base") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    edge = edge.withColumn("open", opened)
    tops = edge.groupBy("path", "g").agg(F.max("open").alias("top"))
    tops = tops.select("path", "g", F.max("top").over(before_group).alias("carried"))
    edge = edge.join(tops, ["path", "g"]).withColumn("begun", F.greatest(F.max("open").over(within), F.col("carried")))
    split = edge.where("first_end is not null").select(
        F.col("begun.id").alias("doc_id"), (F.col("p") + F.col("first_end") - F.col("begun.at") - HEADER).alias("n_tokens")
    )
    return whole.unionByName(split)


def document_lengths(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Write the tokens of `docs` to the shared folder and count them there:
    (doc_id, n_tokens) for every row; null and empty texts have 0 tokens. Other
    columns are not looked at."""
    from leafline.session import scratch_path

    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, doc_id, text)
    return count_tokens(docs.sparkSession, path, block)
