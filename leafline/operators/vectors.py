"""Bags of words, vocabulary, inverse document frequency, TF-IDF and cosine.

A *comment row* has key columns (by default `t_id` and `comment_pos`), the text
`comment` and, from `with_bag` on, `words` and `bag`, the words with their counts.
The counts are made inside the row, so a corpus is never shuffled word by word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.functions.text import tokenize, word_counts

COMMENT_KEYS = ("t_id", "comment_pos")
MAX_TERMS = 2000
# Scores are rounded here before they are ranked. Sums of doubles depend on the
# order tasks finish in; without rounding, equal comments would swap ranks
# from run to run.
RANK_DIGITS = 9
# The empty word stands for the comment itself (no real word is empty): its
# document frequency is the number of comments, all in the same pass.
SELF = ""


def with_words(comments: DataFrame, lower: bool = False, tokens: str | None = None) -> DataFrame:
    """Add `words`. `tokens` names a ready-made array column (say, from a
    morphological tagger) to use instead of splitting `comment`."""
    found = F.array_compact(tokens) if tokens else tokenize(F.col("comment"), lower=lower)
    return comments.withColumn("words", F.coalesce(found, F.array().cast("array<string>")))


def with_bag(comments: DataFrame, lower: bool = False, tokens: str | None = None) -> DataFrame:
    """Add `words` and `bag`, its counted form; see `with_words` for `tokens`."""
    return with_words(comments, lower, tokens).withColumn("bag", word_counts(F.col("words")))


def with_key(bags: DataFrame) -> DataFrame:
    """Add `comment_key`, a digest that stands for the text in later shuffles."""
    return bags.withColumn("comment_key", F.md5("comment"))


def bag_of_words(bags: DataFrame, keys: Sequence[str] = COMMENT_KEYS) -> DataFrame:
    """One row per comment and word.

    `inline` of a computed column would make Spark evaluate that column once more
    in a filter it infers (size > 0); the outer form leaves that out."""
    return bags.select(*keys, F.inline_outer("bag")).where(F.col("term").isNotNull())


def marked(bag: Column) -> Column:
    return F.concat(F.array(F.struct(F.lit(SELF).alias("term"), F.lit(1).cast("long").alias("n"))), bag)


def term_stats(bags: DataFrame) -> DataFrame:
    """(term, tf, df) over the corpus, the `SELF` row included.

    Every word counts towards tf, every distinct word of a comment towards df. The
    sums need no counts per comment, so those are not made here. Partial
    aggregation leaves at most one row per word and task to shuffle."""
    once = F.concat(F.array(F.lit(SELF)), F.array_distinct("words"))
    both = F.array(
        F.struct(F.col("words").alias("terms"), F.lit(1).cast("long").alias("tf"), F.lit(0).cast("long").alias("df")),
        F.struct(once.alias("terms"), F.lit(0).cast("long").alias("tf"), F.lit(1).cast("long").alias("df")),
    )
    rows = bags.select(F.inline(both)).select(F.explode_outer("terms").alias("term"), "tf", "df")
    return rows.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1


def model(stats: DataFrame, max_terms: int) -> DataFrame:
    """The vocabulary of `term_stats` with its IDF, and the `SELF` row with weight
    0: at most `max_terms` + 1 rows whatever the corpus, hence safe to broadcast
    and to put into one window."""
    is_self = F.col("term") == SELF
    top = stats.orderBy(is_self.desc(), F.col("tf").desc(), "term").limit(max_terms + 1)
    n_docs = F.max(F.when(is_self, F.col("df"))).over(Window.partitionBy())
    return top.withColumn("n_docs", n_docs).withColumn(
        "idf", F.when(is_self, F.lit(0.0)).otherwise(smooth_idf(F.col("n_docs"), F.col("df")))
    )


def without(stats: DataFrame, part: DataFrame) -> DataFrame:
    """Statistics of a corpus once a part of it, with statistics `part`, is left out."""
    left = stats.alias("a").join(part.alias("p"), "term", "left").select(
        "term", *[(F.col(f"a.{c}") - F.coalesce(f"p.{c}", F.lit(0))).alias(c) for c in ("tf", "df")]
    )
    return left.where((F.col("df") > 0) | (F.col("term") == SELF))


def vocabulary(bags: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """The `max_terms` most frequent words (ties in word order) with `tf`, `df`,
    `n_docs` and smooth `idf`."""
    return model(term_stats(bags), max_terms).where(F.col("term") != SELF)


def restrict_to_vocabulary(words: DataFrame, vocab: DataFrame) -> DataFrame:
    return words.join(F.broadcast(vocab.select("term")), "term", "left_semi")


def tfidf(bags: DataFrame, vocab: DataFrame, keys: Sequence[str] = COMMENT_KEYS) -> DataFrame:
    """(keys, term, weight) with the weights of each row's `words` at unit length.

    The words of the vocabulary, a bounded number, are read here. Each row's words then
    become a vector over them, are weighted and brought to unit length in the
    row, so no bag is shuffled, and rows need no key of their own."""
    table = vocab.select("term", "idf").collect()
    if not table:
        return bags.limit(0).select(*keys, F.lit("").alias("term"), F.lit(0.0).alias("weight"))
    terms = bags.sparkSession.createDataFrame([(i, r["term"]) for i, r in enumerate(table)], "id int, term string")
    rows = unit_vectors(bags.select(*keys, "words"), table)
    parts = F.unwrap_udt("unit")
    pairs = F.zip_with(parts["indices"], parts["values"], lambda i, w: F.struct(i.alias("id"), w.alias("weight")))
    weighted = rows.select(*keys, F.inline_outer(pairs)).where(F.col("id").isNotNull())
    return weighted.join(F.broadcast(terms), "id").select(*keys, "term", "weight")


def unit_vectors(rows: DataFrame, table: Sequence) -> DataFrame:
    """`rows` with `unit`, the vector of its `words` over the (term, idf) rows of
    `table` at unit length."""
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in table], "words", "counts")
    weighted = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in table]), inputCol="counts", outputCol="weighted")
    unit = Normalizer(p=2.0, inputCol="weighted", outputCol="unit")
    return unit.transform(weighted.transform(counter.transform(rows)))


def score_one(
    bags: DataFrame, fitted: DataFrame, review_words: Sequence[str], keys: Sequence[str] = COMMENT_KEYS
) -> DataFrame:
    """Positive cosines of comments with one review: (keys, comment_key, score).

    `fitted` comes from `model`; its words, a bounded number, are read here. Each
    comment then becomes a vector over them, is weighted, brought to unit length
    and multiplied with the review's vector in its own row, so no comment is
    shuffled. Comments without a word of the review are passed over first."""
    table = [r for r in fitted.collect() if r["term"] != SELF]  # the vocabulary
    place = {r["term"]: i for i, r in enumerate(table)}
    counts = Counter(w for w in review_words if w in place)
    raw = {w: n * table[place[w]]["idf"] for w, n in counts.items()}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    own = sorted(raw)
    if not own:
        return with_key(bags.limit(0)).select(*keys, "comment_key", F.lit(0.0).alias("score"))
    slicer = VectorSlicer(inputCol="unit", outputCol="own", indices=[place[w] for w in own])
    shared = bags.where(F.arrays_overlap("words", F.array(*map(F.lit, own))))
    rows = slicer.transform(unit_vectors(with_key(shared).select(*keys, "comment_key", "words"), table))
    q = F.array(*[F.lit(raw[w] / norm) for w in own])
    dot = F.aggregate(F.zip_with(vector_to_array("own"), q, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = rows.select(*keys, "comment_key", F.round(dot, RANK_DIGITS).alias("score"))
    return scored.where(F.col("score") > 0)
