"""Words, lower case and hash splits, the same in Spark and in Arrow tasks.

A word is a run of anything but space and the control characters 09 to 0D. Only
A to Z change under lower case here, so the byte length of a text never does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"
#: bytes of text that a task works on at a time; one longer text is a chunk of its own
CHUNK_BYTES = 4 << 20
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…–—¿¡"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column | str) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Splitting at runs of separators gives an
    empty first or last piece where the text begins or ends with one."""
    pieces = F.split(text, SPACE)
    empty = F.when(F.get(pieces, F.lit(0)) == "", 1).otherwise(0) + F.when(
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1
    ).otherwise(0)
    return F.coalesce(F.size(pieces) - empty, F.lit(0)).cast("long")


def crc_of(key: Column | str) -> Column:
    """crc32 of a key written as text; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")))


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


class Shared:
    """A value that is broadcast to all executors by content, its classes too, so
    that they need not be able to import them; `value` loads it once per task."""

    def __init__(self, spark: SparkSession, value: object):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.loaded: list = []

    @property
    def value(self):
        if not self.loaded:
            self.loaded.append(pickle.loads(self.packed.value))
        return self.loaded[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `limit` bytes of text, at one row least."""
    # the system's allocator gives memory back between chunks, Arrow's own keeps it
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in lower case, and where each text's words begin
    (one more entry than texts). A null text has none."""
    # lower case comes before any cast: Arrow's kernel misreads the cast of a slice
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().cast(pa.large_string())
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not keep.all():
        flat = flat.filter(pa.array(keep))
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
    return flat, offsets


def bare_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case without punctuation around them, and where each
    text's words begin; what is punctuation only is no word."""
    # lower case comes before any cast: Arrow's kernels misread the cast of a slice
    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = pc.utf8_trim(lists.flatten().cast(pa.large_string()), characters=PUNCTUATION)
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[offsets]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` in each segment; 0 for an empty one."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def hash_bytes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, from its bytes alone."""
    strings = strings.cast(pa.large_string())
    n = len(strings)
    if not n:
        return np.zeros(0, np.uint64)
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int64)[strings.offset : strings.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    length = np.diff(ends)
    out = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D)
    at, live = ends[:-1].copy(), np.arange(n)
    left = length.copy()
    with np.errstate(over="ignore"):
        while len(live):
            live = live[left[live] > 0]
            h = out[live] ^ raw[at[live]].astype(np.uint64)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out[live] = h ^ (h >> np.uint64(32))
            at[live] += 1
            left[live] -= 1
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As `words`, with a 64-bit hash for each word; every distinct word is
    hashed once per call."""
    flat, offsets = words(texts)
    coded = flat.dictionary_encode()
    return hash_bytes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)], offsets
