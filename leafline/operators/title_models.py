"""One TF-IDF model per reviewed title, fitted on the comments of all others.

Only the words of the title itself set its model apart from that of all comments, so
a model is the statistics of all comments less those of the title. Words are
numbered by their frequency in all comments; `counts` is a comment's sparse vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators import vectors as V
from leafline.session import materialize

KEYS = (*V.COMMENT_KEYS, "comment_key")


@dataclass
class Base:
    """The most frequent words of all comments, by frequency, then by word."""

    terms: list[str]
    tf: np.ndarray
    df: np.ndarray
    n_docs: int
    complete: bool  # no other words exist

    def counts(self, words: DataFrame) -> DataFrame:
        """`words` with `counts`, the numbers of these words in its array `words`."""
        return CountVectorizerModel.from_vocabulary(self.terms, "words", "counts").transform(words).drop("words")

    def idf(self, max_terms: int) -> np.ndarray:
        """Inverse document frequency of each word, 0 beyond the first `max_terms`."""
        idf = np.log((1 + self.n_docs) / (1 + self.df)) + 1
        idf[max_terms:] = 0
        return idf


def base_terms(stats: DataFrame, count: int) -> Base:
    """The first `count` words of `term_stats`, a bounded number, on the driver."""
    is_self = F.col("term") == V.SELF
    rows = stats.orderBy(is_self.desc(), F.col("tf").desc(), "term").limit(count + 1).collect()
    n_docs = next((r["df"] for r in rows if r["term"] == V.SELF), 0)
    words = [r for r in rows if r["term"] != V.SELF][:count]
    tf, df = (np.array([r[c] for r in words], np.float64) for c in ("tf", "df"))
    return Base([r["term"] for r in words], tf, df, n_docs, len(rows) <= count)


def comment_rows(comments: DataFrame, base: Base) -> DataFrame:
    """(cid, KEYS, copies, counts): comments alike in all keys become one row with their
    number, in the map tasks already, so that copies crowd no task."""
    bags = V.with_key(V.with_words(comments, lower=True)).select(*KEYS, "words")
    once = bags.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies"), F.first("words").alias("words"))
    return base.counts(once).withColumn("cid", F.monotonically_increasing_id())


def numbers(counts: Column | str) -> Column:
    """The sparse vector's parts: struct with `indices`, ascending, and `values`."""
    return F.unwrap_udt(counts)


def own_counts(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """(t_id, id, tf, df) of the words in each title's own comments; id -1 counts
    the comments."""
    parts = rows.join(titles, "t_id", "left_semi").select("t_id", "copies", numbers("counts").alias("c"))
    itself = F.array(F.struct(F.lit(-1).alias("id"), F.lit(1.0).alias("n")))
    pairs = F.zip_with("c.indices", "c.values", lambda i, n: F.struct(i.alias("id"), n.alias("n")))
    each = parts.select("t_id", "copies", F.inline(F.concat(itself, pairs)))
    return each.groupBy("t_id", "id").agg(F.sum(F.col("copies") * F.col("n")).alias("tf"), F.sum("copies").cast("double").alias("df"))


MODEL = "t_id string, n_docs double, idf array<double>, dropped array<int>, enough boolean"


def title_models(own: DataFrame, base: Base, max_terms: int) -> DataFrame:
    """(t_id, n_docs, idf, dropped, enough) of each title of `own` (t_id, id, tf,
    df): the weights of `base`'s words once the title's comments are left out, 0
    for words that are then not among the `max_terms` most frequent. `dropped` are
    words that are among them in all comments only. `enough` says that no word
    beyond `base` can have come in: words of other titles keep their frequencies, so
    `max_terms` of those in `base` leave no place. A title has at most as many rows as `base` has words."""
    terms, tf, df, n_docs, complete = base.terms, base.tf, base.df, base.n_docs, base.complete
    by_word = np.empty(len(terms), np.int64)
    by_word[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))

    def fit(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        word = ids >= 0
        left = [x.copy() for x in (tf, df)]
        for x, name in zip(left, ("tf", "df")):
            x[ids[word]] -= group.column(name).to_numpy()[word]
        n = n_docs - group.column("df").to_numpy()[~word].sum()
        order = np.lexsort((by_word, -left[0]))
        kept = order[left[1][order] > 0][:max_terms]
        idf = np.zeros(len(tf))
        idf[kept] = np.log((1 + n) / (1 + left[1][kept])) + 1
        dropped = np.flatnonzero(idf[:max_terms] == 0)
        enough = complete or len(tf) - int(word.sum()) >= max_terms
        return pa.table(
            [group.column("t_id")[:1], pa.array([n], pa.float64()), pa.array([idf], pa.list_(pa.float64())),
             pa.array([dropped], pa.list_(pa.int32())), pa.array([enough])],
            names=["t_id", "n_docs", "idf", "dropped", "enough"],
        )

    return own.groupBy("t_id").applyInArrow(fit, MODEL)


@dataclass
class Fitted:
    base: Base
    rows: DataFrame  # of comment_rows
    models: DataFrame


def fit_titles(comments: DataFrame, titles: DataFrame, fit_on: DataFrame | None, max_terms: int, count: int) -> Fitted | None:
    """The model of each title in `titles` (t_id; null for all comments), on
    the comments of all other titles, or one model of `fit_on` for a null title,
    from the `count` most frequent words. None without any word."""
    base = base_terms(V.term_stats(V.with_words(comments if fit_on is None else fit_on, lower=True)), count)
    if not base.terms:
        return None
    rows = materialize(comment_rows(comments, base), "comment-rows")
    own = titles.select("t_id", F.lit(-1).alias("id"), F.lit(0.0).alias("tf"), F.lit(0.0).alias("df"))
    if fit_on is None:
        own = own.unionByName(own_counts(rows, titles.where(F.col("t_id").isNotNull())))
    return Fitted(base, rows, materialize(title_models(own, base, max_terms), "title-models"))


def weights(counts: Column, idf: Column) -> Column:
    """array<double>: count x weight of each word of a comment or review."""
    return F.zip_with(counts["indices"], counts["values"], lambda i, n: n * F.get(idf, i))


def norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))

