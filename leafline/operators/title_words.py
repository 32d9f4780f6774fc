"""Each title's comments as documents: words, counts and document frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.operators import vectors as V
from leafline.session import broadcast_if_small, materialize

# The bounds on the share of a title's comments a word may be in.
NO_BELOW = 1
NO_ABOVE = 0.7
DOC_KEYS = ("t_id", "comment_key")


def title_documents(comments: DataFrame, tokens: str | None = None) -> DataFrame:
    """(t_id, comment_key, comment_pos, bag): the distinct comments of each title.
    The same comment seen on several days counts once."""
    extra = [] if tokens is None else [F.min(tokens).alias(tokens)]
    once = (
        comments.where(F.col("t_id").isNotNull())
        .groupBy("t_id", "comment")
        .agg(F.min("comment_pos").alias("comment_pos"), *extra)
    )
    return V.with_bag(V.with_key(once), tokens=tokens).select(*DOC_KEYS, "comment_pos", "bag")


def _term_df(docs: DataFrame, no_below: int, no_above: float) -> DataFrame:
    """Words and comments of a title are counted in one aggregation, the comments
    as the empty word, and stored once. A title's number of comments then goes to its words
    without a shuffle, so that a large title is no crowded key."""
    rows = docs.select("t_id", F.explode(V.marked(F.col("bag"))["term"]).alias("term"))
    df = materialize(rows.groupBy("t_id", "term").agg(F.count(F.lit(1)).alias("df")), "title-term-df")
    n_docs = df.where(F.col("term") == V.SELF).select("t_id", F.col("df").alias("n_docs"))
    kept = (F.col("df") >= no_below) & (F.col("df") <= F.floor(F.lit(no_above) * F.col("n_docs")))
    words = df.where(F.col("term") != V.SELF).join(broadcast_if_small(n_docs), "t_id")
    return words.select("t_id", "term", "df", "n_docs", kept.alias("kept"))


def title_terms(docs: DataFrame, no_below: int = NO_BELOW, no_above: float = NO_ABOVE) -> DataFrame:
    """(t_id, term, df, n_docs) of the words kept: in at least `no_below` and at
    most floor(`no_above` x comments) of a title's comments."""
    return _term_df(docs, no_below, no_above).where("kept").drop("kept")


def dropped_terms(docs: DataFrame, no_below: int = NO_BELOW, no_above: float = NO_ABOVE) -> DataFrame:
    """(t_id, dropped): the other words of each title that has some, as an array.
    At the usual bounds these are few: a title cannot have more words in over
    70% of its comments than 1/0.7 times the words of an average comment."""
    rows = _term_df(docs, no_below, no_above).where("not kept")
    return rows.groupBy("t_id").agg(F.collect_list("term").alias("dropped"))


def keep_terms(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` with the dropped words taken out of each bag, in its row."""
    found = docs.join(broadcast_if_small(dropped), "t_id", "left")
    bag = F.filter("bag", lambda w: ~F.coalesce(F.array_contains("dropped", w.term), F.lit(False)))
    return found.withColumn("bag", bag).drop("dropped")


def words_of(docs: DataFrame, keys: tuple[str, ...] = (*DOC_KEYS, "comment_pos")) -> DataFrame:
    return V.bag_of_words(docs, keys).select(*keys, "term", "n")


def title_dtm(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """(t_id, comment_key, comment_pos, term, n) without the dropped words."""
    return words_of(keep_terms(docs, dropped))


def skipped_titles(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Titles left without a single word, e.g. those with one comment."""
    return docs.select("t_id").distinct().join(terms.select("t_id").distinct(), "t_id", "left_anti")
