"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.text import Shared, chunks, segment_sums
from leafline.session import materialize

UNDETERMINED = "und"
#: n-grams of 1 to 3 characters share so many counters
BITS = 15
ORDERS = (1, 2, 3)
#: added to each count
SMOOTHING = 0.5
#: for the score, not the choice, evidence of a text of this many n-grams or more counts as of so
#: many: the n-grams of a text depend on each other, so the plain posterior is too sure
EVIDENCE = 200
#: a text is in no known language if the mean log-probability of its n-grams under
#: the best one is so far below that of a typical labelled text; a text of few n-grams,
#: which says less, may be as much further below as SHORT is more than they are
MARGIN, SHORT = 3.5, 20
#: bytes of text that a task scores at a time; its n-grams take some hundred times that
SCORE_BYTES = 1 << 17
#: languages whose counters a task holds at a time
COUNTED_LANGS = 64
#: parts of the range of all values that are counted in one round on the way to their median
BINS = 1 << 10


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (2^BITS, langs), log probabilities, float32
    prior: np.ndarray


def grams(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams of all texts, and the offsets of each
    text's n-grams. Texts are lower-cased; a text is framed by spaces, runs of
    anything but letters count as one space."""
    joined = [f" {t.lower()} " for t in texts]
    raw = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)
    # below 0x80 only a-z are letters; what is above counts as a letter
    letter = (raw >= 0x80) | ((raw >= 97) & (raw <= 122))
    first = np.zeros(len(raw), bool)
    first[offsets[:-1]] = True
    keep = letter | first
    keep[1:] |= ~letter[1:] & letter[:-1]
    kept = np.concatenate([[0], np.cumsum(keep)])
    chars, offsets = np.where(letter, raw, 32)[keep].astype(np.uint32), kept[offsets]
    starts = np.repeat(offsets[1:], np.diff(offsets))  # end of the text of each character
    code = np.zeros(len(chars), np.uint32)
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            m = len(chars) - order + 1
            if m <= 0:
                return
            code = (code[:m] * np.uint32(0x01000193)) ^ (chars[order - 1 :] * np.uint32(0x9E3779B1))
            if order not in ORDERS:
                continue
            inside = np.arange(order - 1, len(chars)) < starts[:m]
            hashed = ((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)
            at = np.concatenate([[0], np.cumsum(inside)])
            yield hashed[inside].astype(np.int64), at[np.minimum(offsets, m)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, summed within the task."""
    totals: dict[str, np.ndarray] = {}

    def summed() -> Iterator[pa.RecordBatch]:
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "gram", "n"]
            )
        totals.clear()

    for b in chunks(batches, "text", SCORE_BYTES):
        langs = b.column("lang").to_pylist()
        texts = b.column("text").to_pylist()
        for lang in sorted(set(langs)):
            if lang not in totals and len(totals) == COUNTED_LANGS:
                yield from summed()
            total = totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
            for g, _ in grams([t for t, x in zip(texts, langs) if x == lang], BITS):
                total += np.bincount(g, minlength=1 << BITS)
    yield from summed()


def labelled(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, text) of all rows with text and language."""
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    return known.select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model from all rows of `docs` with text and language, which are read twice."""
    return fit_labelled(labelled(docs, lang, text))


def fit_labelled(known: DataFrame) -> Model:
    """A model from all `labelled` rows. Its size is languages times 2^BITS
    counters. Without any row it knows no language and calls every text undetermined."""
    prior = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(prior)
    counts = np.full((1 << BITS, len(langs)), SMOOTHING)
    summed = known.select("lang", "text").mapInArrow(_count, "lang string, gram int, n long")
    table = summed.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # languages times 2^BITS rows
    place = {x: i for i, x in enumerate(langs)}
    counts[table["gram"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]] += table["n"].to_numpy()
    weights = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    seen = np.array([prior[x] for x in langs], float)
    return Model(langs, weights, np.log(seen / seen.sum()) if langs else seen)


fit_sample = fit_labelled  # the name in use before


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def likelihoods(texts: list[str], model: Model, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of all n-grams of each text in each language, and their number."""
    total, n = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    for g, offsets in grams(texts, bits):
        for k in range(len(model.langs)):
            total[:, k] += segment_sums(model.weights[:, k][g], offsets)
        n += np.diff(offsets)
    return total, n


def scores(texts: list[str], model: Model, bits: int = BITS) -> np.ndarray:
    """Posterior of each language for each text, its evidence bounded by EVIDENCE."""
    return _posterior(*likelihoods(texts, model, bits), model)


def _posterior(total: np.ndarray, n: np.ndarray, model: Model) -> np.ndarray:
    total = total * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None] + model.prior
    total -= total.max(axis=1, keepdims=True)
    p = np.exp(total)
    return p / p.sum(axis=1, keepdims=True)


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """(language or undetermined, score) of each text: the language that all its
    n-grams and the prior make likeliest, and its posterior."""
    live = [i for i, t in enumerate(texts) if model.langs and has_letter(t)]
    pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if live:
        total, n = likelihoods([texts[i] for i in live], model)
        best = (total + model.prior).argmax(axis=1)
        for i, k in zip(live, best):
            pred[i] = model.langs[k]
        score[live] = _posterior(total, n, model)[np.arange(len(live)), best]
    return pred, score


def in_language(texts: list[str | None], model: Model, level: float) -> list[bool]:
    """Whether each text has a letter and is in a language of the model, by the
    rule of MARGIN and SHORT around `level`."""
    kept = [has_letter(t) for t in texts]
    live = [i for i, k in enumerate(kept) if k and model.langs]
    if live:
        total, n = likelihoods([texts[i] for i in live], model)
        n = np.maximum(n, 1)
        for i, ok in zip(live, total.max(axis=1) / n >= level - MARGIN * (1 + SHORT / n)):
            kept[i] = bool(ok)
    return kept


def exact_median(values: DataFrame) -> float | None:
    """The median of the doubles `m`, none of them null, that `values`, cheap to read, holds;
    null without any. Each round counts them in BINS parts of the range that the
    middle ones are in, so neither a task nor the driver holds more than BINS rows."""
    low, high, below = None, None, 0
    while True:
        if low is None:
            total, low, high = values.agg(F.count("m"), F.min("m"), F.max("m")).first()
            if not total:
                return None
            ranks = (total - 1) // 2, total // 2
        if low == high:
            return low
        part = F.floor((F.col("m") - low) / (high - low) * (BINS - 1)).alias("part")
        inside = values.where(F.col("m").between(low, high)).groupBy(part)
        parts = inside.agg(F.count("m").alias("n"), F.min("m").alias("low"), F.max("m").alias("high")).orderBy("part").collect()
        ends = below + np.cumsum([r["n"] for r in parts])
        first, last = (int(np.searchsorted(ends, rank, side="right")) for rank in ranks)
        if first != last:
            return (parts[first]["high"] + parts[last]["low"]) / 2
        low, high = parts[first]["low"], parts[first]["high"]
        below = int(ends[first]) - parts[first]["n"]


def typical_level(known: DataFrame, model: Model) -> float:
    """The median over all `labelled` rows of a text's mean n-gram log-probability
    under its best language; without a language nothing is below it."""
    shared = Shared(known.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", SCORE_BYTES):
            total, n = likelihoods(b.column("text").to_pylist(), shared.value)
            mean = total.max(axis=1, initial=-np.inf) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([pa.array(mean[n > 0])], ["m"])

    if not model.langs:
        return -np.inf
    found = exact_median(materialize(known.select("text").mapInArrow(run, "m double"), "language-levels"))
    return -np.inf if found is None else found


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row. A text that is null or has no
    letter is undetermined, with score 0, as is every text if the model knows no
    language; ties go to the first language by code point. Whole texts are
    scored in chunks of bounded size, one long text at a time. Null or repeated
    ids are rows like others; other columns are not looked at."""
    shared = Shared(docs.sparkSession, model)  # languages times 2^BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", SCORE_BYTES):
            pred, score = predict(b.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_determined(docs: DataFrame, model: Model, level: float = -np.inf, text: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, whose text is in a language of the model by
    `in_language`. With the default level, or a model that knows no
    language, only null and letterless texts go."""
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text, SCORE_BYTES):
            yield b.filter(pa.array(in_language(b.column(text).to_pylist(), shared.value, level), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
