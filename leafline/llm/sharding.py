"""A reproducible shuffle into shards, by a permutation of row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafline.session import materialize

#: the rows are numbered within so many groups side by side
BUCKETS = 1 << 14
ROUNDS = 6


def feistel(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Where each row number of [0, n) goes: a permutation of [0, n). A balanced
    Feistel network permutes the least domain of 4^k numbers that holds n; a
    result of n or more is sent through it again (cycle walking)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    rng = np.random.Generator(np.random.PCG64(seed))
    keys = rng.integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> shift, v & mask
        for key in keys:
            h = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
        return left << shift | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(rows, np.uint64))
        while (far := out >= np.uint64(n)).any():
            out[far] = once(out[far])
    return out.astype(np.int64)


def place(rows: np.ndarray, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers, from the numbers alone."""
    at = feistel(rows, n, seed)
    return at % shards, at // shards


def numbered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, row), n: every row with its own number of
    [0, n), and how many rows there are. The numbers depend on ids and texts
    only, not on how the rows are stored or dealt out: rows are grouped by a
    hash into a fixed number of buckets, ordered there, and numbered on from
    the count of the buckets before."""
    body = F.coalesce(F.col(text).cast("binary"), F.unhex(F.lit("")))
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.col(text).isNull().alias("__none"),
    ).withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(BUCKETS)).cast("int"))
    slim = materialize(slim, "shard-rows")
    counts = slim.groupBy("__bucket").agg(F.count("*").alias("__c"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    starts = counts.select("__bucket", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__start"))
    order = Window.partitionBy("__bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "text_crc32", "size", "__none")
    rows = slim.withColumn("__i", F.row_number().over(order)).join(F.broadcast(starts), "__bucket")
    n = slim.count()
    return rows.select("doc_id", "size", "text_crc32", (F.col("__start") + F.col("__i") - 1).alias("row")), n


def shard_documents(docs: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot) for every row. Shards differ
    by one row at most, and slots run from 0 without gaps; `place` computes both
    from a row number, so any shard's rows can be found without a table.

    size: bytes of the text plus 8; a null text has 8 and the checksum 0, as an
    empty one. Null ids and repeated rows are rows like others. Rows that agree
    in all that is used are interchangeable. No rows give no rows; other columns
    of `docs` are not looked at. Only ids, sizes and checksums are shuffled."""
    if shards < 1:
        raise ValueError("shards must be positive")
    rows, n = numbered(docs, doc_id, text)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, slot = place(b.column("row").to_numpy(), n, shards, seed)
            names = [*b.schema.names, "shard", "slot"]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], names=names)

    return rows.mapInArrow(dealt, "doc_id long, size long, text_crc32 long, row long, shard int, slot long")
