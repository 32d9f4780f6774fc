"""Toxic passages: maximum-scoring segments of word log-odds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.text import Shared, bare_words, chunks, segment_sums
from leafline.session import materialize

#: labelled documents that the model is fitted on, at most (chosen by a hash of the id)
FIT_DOCS = 20_000
#: words in the model, at most: those with the surest log-odds
MODEL_WORDS = 20_000
#: weight of the prior in documents, spread over words as they occur in all labelled text
PRIOR = 50.0
#: standard deviations from which a word's log-odds count
SURE = 3.0
#: what a word without sure log-odds takes off a passage
DRIFT = 0.1
#: expected number of such passages in a clean text, up to which a passage is reported
EVALUE = 0.05


@dataclass
class Model:
    words: list[str]
    odds: np.ndarray
    decay: float  # lambda of the extreme-value law
    rate: float  # K of the extreme-value law
    slope: float
    level: float


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, sum) of a row of scores, left
    to right, in one linear scan (Ruzzo and Tompa). Runs of positive scores are
    taken together, so the loop only sees where a text has some."""
    positive = scores > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8)))
    found: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, end
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        before, after = total[first], total[end]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= before:
                j -= 1
            if j < 0 or found[j][1] >= after:
                break
            before, first = found[j][0], found[j][2]
            del found[j:]
        found.append((before, after, first, end))
    return [(first, end - 1, float(after - before)) for before, after, first, end in found]


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, clean): in how many documents of either label a word occurs."""
    for b in chunks(batches, "text"):
        flat, offsets = bare_words(b.column("text"))
        coded = flat.dictionary_encode()
        n = max(1, len(coded.dictionary))
        pairs = np.unique(np.repeat(np.arange(b.num_rows), np.diff(offsets)) * n + coded.indices.to_numpy(zero_copy_only=False))
        is_toxic = b.column("toxic").to_numpy(zero_copy_only=False)[pairs // n] == 1
        toxic = np.bincount(pairs[is_toxic] % n, minlength=n)
        clean = np.bincount(pairs[~is_toxic] % n, minlength=n)
        if len(coded.dictionary):
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(toxic), pa.array(clean)], ["word", "toxic", "clean"])


def _scan(batch: pa.RecordBatch, vocabulary: pa.Array, odds: np.ndarray) -> Iterator[tuple[int, list]]:
    """(number of words, maximal segments) of each text."""
    flat, offsets = bare_words(batch.column("text"))
    at = pc.fill_null(pc.index_in(flat, value_set=vocabulary), len(odds)).to_numpy(zero_copy_only=False)
    scores = np.append(odds, -DRIFT)[at]
    some = segment_sums((scores > 0).astype(float), offsets)
    for i in range(batch.num_rows):
        a, z = offsets[i], offsets[i + 1]
        yield int(z - a), segments(scores[a:z]) if some[i] else []


def _evidence(n: int, found: list, decay: float, rate: float) -> float:
    """Sum over passages of -ln of the number expected by chance, where below 1."""
    floor = np.log(rate * max(n, 1))
    return sum(max(0.0, decay * s - floor) for _, _, s in found)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, level) by Newton's method, with a weak pull to 0; the slope is kept positive."""
    design, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - 1e-3 * w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), grad)
        w += np.clip(step, -2, 2)
    return max(float(w[0]), 1e-6), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_docs: int = FIT_DOCS) -> Model:
    """A model from documents with a label (doc_id, toxic 0 or 1), `max_docs` of
    them at most. A document is toxic if any of its labels says so; null labels
    and ids are passed over; equal texts count once for a label.

    Log-odds of a word between toxic and clean documents have a Dirichlet prior
    that spreads as the word does in both; those within SURE standard deviations
    of 0 are dropped. Passages of the clean documents give the extreme-value law
    of chance scores, and a logistic curve turns evidence beyond it into the
    probability of the label. With labels of one kind only, every text gets
    their share as its score."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id")
    # labels of rows that are not in `docs` take part in the choice, so it is cut to `docs` first
    picked = materialize(picked.join(slim.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "toxic-labels")
    sample = slim.join(F.broadcast(picked), "doc_id")  # max_docs numbers
    sample = materialize(sample.groupBy("text", "toxic").agg(F.first("doc_id").alias("doc_id")), "toxic-sample")
    share = sample.agg(F.avg("toxic").alias("p")).first()["p"] or 0.0
    constant = Model([], np.zeros(0), 1.0, 1.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    if share in (0.0, 1.0):
        return constant
    counts = sample.mapInArrow(_documents_with, "word string, toxic long, clean long")
    counts = materialize(counts.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "toxic-words")
    n = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum(F.col("t") + F.col("c")).alias("all")).first()
    if not n["t"] or not n["c"]:
        return constant
    kinds = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    alpha = PRIOR * (F.col("t") + F.col("c")) / float(kinds[0] + kinds[1])
    side = lambda k, docs_of: F.log((F.col(k) + alpha) / (docs_of + PRIOR - F.col(k) - alpha + 1.0))
    odds = counts.where("t + c >= 3").select(
        "word",
        (side("t", float(kinds[1])) - side("c", float(kinds[0]))).alias("odds"),
        F.sqrt(1 / (F.col("t") + alpha) + 1 / (F.col("c") + alpha)).alias("sd"),
    )
    sure = odds.where(F.abs(F.col("odds")) > SURE * F.col("sd")).orderBy(F.desc(F.abs(F.col("odds") / F.col("sd"))), "word")
    chosen = sure.limit(MODEL_WORDS).collect()
    model = Model([r["word"] for r in chosen], np.array([r["odds"] for r in chosen]) - DRIFT, 1.0, 1.0, 1.0, 0.0)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(model.words, pa.large_string())
        for b in chunks(batches, "text"):
            n, scores = zip(*((n, [s for *_, s in found]) for n, found in _scan(b, vocabulary, model.odds)))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(n), pa.array(scores, pa.list_(pa.float64()))], ["toxic", "n", "s"])

    scanned = materialize(sample.select("toxic", "text").mapInArrow(passages, "toxic int, n long, s array<double>"), "toxic-scores")
    chance = scanned.where("toxic = 0").agg(
        F.sum("n").alias("n"), F.sum(F.size("s")).alias("k"), F.sum(F.aggregate("s", F.lit(0.0), lambda a, x: a + x)).alias("s")
    ).first()
    # passages above 0 come at a rate, and their scores fall off exponentially
    model.decay = (chance["k"] + 1) / (chance["s"] + 1)
    model.rate = (chance["k"] + 1) / max(chance["n"], 1)
    rows = scanned.collect()  # max_docs at most, each the few passages of a text
    x = np.array([_evidence(r["n"], [(0, 0, s) for s in r["s"]], model.decay, model.rate) for r in rows])
    model.slope, model.level = _logistic(x, np.array([float(r["toxic"]) for r in rows]))
    return model


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, passages) for every row: probability of the toxic label,
    and every passage whose score is not expected by chance, as (first, last,
    score, evalue) with the numbers of its first and last word from 0. Words are
    read in lower case without punctuation around them.

    Null and empty texts have no passages and the least score. Whole texts are
    scanned, in chunks of bounded size; a text's cost is linear in its length.
    Repeated rows and null ids are rows like others; other columns are not
    looked at."""
    shared = Shared(docs.sparkSession, model)  # MODEL_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        vocabulary = pa.array(m.words, pa.large_string())
        span = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("evalue", pa.float64())])
        for b in chunks(batches, "text"):
            score, passages = [], []
            for n, found in _scan(b, vocabulary, m.odds):
                evidence = _evidence(n, found, m.decay, m.rate)
                score.append(float(1 / (1 + np.exp(-np.clip(m.slope * evidence + m.level, -30, 30)))))
                expected = [(f, z, s, float(m.rate * n * np.exp(-m.decay * s))) for f, z, s in found]
                passages.append([dict(zip(("first", "last", "score", "evalue"), e)) for e in expected if e[3] <= EVALUE])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score), pa.array(passages, pa.list_(span))], ["doc_id", "score", "passages"])

    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(
        run, f"doc_id {kind}, score double, passages array<struct<first: long, last: long, score: double, evalue: double>>"
    )
