"""Runs of periodic repetition: stretches of words that repeat themselves.

A run with period q is a stretch of words in which words q apart are identical,
that no neighbouring word extends, and that is long enough. q is its smallest
period. Texts are cut at words too rare to be in a run until nothing changes;
only what is left is scanned lag by lag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.text import chunks

#: words in a run, at least; and twice its period, at least
MIN_WORDS = 12
#: at a larger distance the two sides of a lag are compared by block hashes
DIRECT = 4096


def plain_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as they stand, and where each text's words begin."""
    # a copy, not a slice: Arrow's kernels misread the cast of a slice
    texts = pc.fill_null(texts, "").take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().cast(pa.large_string())
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[offsets]


def surviving_segments(ids: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(begin, end) of the segments that may hold runs, over all texts at once.

    A word of a run comes back a period away, in the same run. So a word that is
    alone of its kind in its segment is in no run, and splits it; what falls short
    of `min_words` goes. Pieces are looked at again until none of them splits."""
    at = np.arange(len(ids))
    segment = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    done: list[tuple[int, int]] = []
    while len(at):
        key = segment * (int(ids.max()) + 1) + ids[at]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        alone = np.zeros(len(at), bool)
        alone[order[first[np.diff(first, append=len(at)) == 1]]] = True
        split = np.bincount(segment[alone], minlength=segment[-1] + 1) > 0
        fresh = np.diff(segment, prepend=-1) != 0
        whole = ~split[segment]
        begins = at[fresh & whole]
        ends = at[np.append(fresh[1:], True) & whole] + 1
        done += [(b, e) for b, e in zip(begins.tolist(), ends.tolist()) if e - b >= min_words]
        live = ~whole & ~alone
        at, segment = at[live], segment[live]
        if not len(at):
            break
        piece = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0)) - 1
        large = np.bincount(piece)[piece] >= min_words
        at, piece = at[large], piece[large]
        segment = np.cumsum(np.diff(piece, prepend=-1) != 0) - 1
    return sorted(done)


def _stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of at least `least` true values."""
    edge = np.flatnonzero(np.diff(equal.astype(np.int8), prepend=0, append=0))
    begins, ends = edge[::2], edge[1::2]
    long = ends - begins >= least
    return list(zip(begins[long].tolist(), ends[long].tolist()))


def scan_lags(w: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in one segment, by lags from 1 up.

    A run of period q and length n is a stretch of n - q words equal to those q
    further on, and n - q is at least q. Lags go up, and a stretch that has a
    smaller period is the run of that period again (two periods of a stretch as
    long as both share their greatest divisor), so each run is reported once.

    Where many words lie side by side, a stretch of q words holds a whole block of
    half as many; only blocks at multiples of their size are compared, by hash,
    and words around those that agree. That is about m log m for all lags of m
    words. Blocks inside a known run whose period divides the lag say nothing new."""
    m, runs, seen = len(w), [], set()
    known: list[tuple[int, int, int]] = []  # begin, end, period
    with np.errstate(over="ignore"):
        if m > DIRECT:
            mixed = (w.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            power = np.cumprod(np.full(m + 1, 0xD1342543DE82EF95, np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((mixed ^ (mixed >> np.uint64(32))) * power[:m])])
        for q in range(1, m // 2 + 1):
            least = max(min_words - q, q)
            if q < min_words or m - q <= DIRECT:
                found = _stretches(w[: m - q] == w[q:], least)
            else:
                h = (q + 1) // 2
                p = np.arange(0, m - q - h + 1, h)
                same = (sums[p + h] - sums[p]) * power[q - 1] == sums[p + q + h] - sums[p + q]
                if not same.any():
                    continue
                for b, e, period in known:
                    if e - b >= q + h and q % period == 0:
                        same[(p >= b) & (p <= e - q - h)] = False
                found = []
                for i, j in _stretches(same, 1):
                    low, high = max(0, int(p[i]) - h), min(m - q, int(p[j - 1]) + 2 * h)
                    found += [(low + b, low + e) for b, e in _stretches(w[low:high] == w[low + q : high + q], least)]
            for b, e in found:
                if (b, e + q) not in seen:
                    seen.add((b, e + q))
                    known.append((b, e + q, q))
                    runs.append((b, e + q - b, q))
        return runs


def _texts_runs(ids: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, start, length, period) rows by text, start and period, and a mark
    for each word that a run repeats, i.e. holds after its first period."""
    rows = []
    for b, e in surviving_segments(ids, offsets, min_words):
        text = int(np.searchsorted(offsets, b, side="right")) - 1
        rows += [(text, b + s - int(offsets[text]), n, q) for s, n, q in scan_lags(ids[b:e], min_words)]
    table = np.array(sorted(rows, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)
    change = np.zeros(len(ids) + 1, np.int64)
    begin = offsets[table[:, 0]] + table[:, 1]
    np.add.at(change, begin + table[:, 3], 1)
    np.add.at(change, begin + table[:, 2], -1)
    return table, np.cumsum(change)[:-1] > 0


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of `docs`.

    runs: (start, length, period) of every run of at least `min_words` words and
    two periods, by start, then period; words are counted from 0. Words are
    what stands between spaces and the characters 09 to 0D, case and all.
    collapsed: the text's words with each run cut to its first period, joined by
    one space.

    Whole texts are read, in chunks of bounded size, one long text at a time; no
    rows are shuffled. Null texts count as empty: no runs, and an empty collapsed
    text. Null and repeated ids are rows like others; other columns are not
    looked at; no rows give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        for b in chunks(batches, "text"):
            flat, offsets = plain_words(b.column("text"))
            ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            table, repeated = _texts_runs(ids, offsets, min_words)
            ends = np.searchsorted(table[:, 0], np.arange(b.num_rows + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in (1, 2, 3)], fields=list(kind))
            kept = np.concatenate([[0], np.cumsum(~repeated)])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), flat.filter(pa.array(~repeated)).cast(pa.string()))
            collapsed = pc.binary_join(lists, " ")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), runs), collapsed], ["doc_id", "runs", "collapsed"]
            )

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
