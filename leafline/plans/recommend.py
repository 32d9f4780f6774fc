"""Titles whose comments read like a given review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions.text import tokenize, words_of
from leafline.operators import vectors as V
from leafline.operators.ranking import favourites, genre_boost, max_score_per_title, ranked
from leafline.operators.threshold import most_similar, review_rounds, review_words
from leafline.operators.title_models import fit_titles
from leafline.session import BROADCAST_ROWS, materialize

SKIP_TOP = 1
HITS = 20
TITLES = 5
REVIEW_KEYS = ("user_id", "user_t_id")


def review_tfidf(comments: DataFrame, reviews: DataFrame, max_terms: int = V.MAX_TERMS) -> DataFrame:
    """(user_id, user_t_id, term, weight): reviews in the vocabulary of the comments."""
    vocab = V.vocabulary(V.with_bag(comments, lower=True), max_terms)
    return _review_vectors(reviews, vocab)


def _review_vectors(reviews: DataFrame, vocab: DataFrame) -> DataFrame:
    words = F.coalesce(tokenize(F.col("review"), lower=True), F.array().cast("array<string>"))
    return V.tfidf(reviews.select("user_id", F.col("t_id").alias("user_t_id"), words.alias("words")), vocab, keys=REVIEW_KEYS)


def corpus_stats(comments: DataFrame, tokens: str | None = None) -> DataFrame:
    """Word statistics of all comments. Kept as a table, they spare each single
    review the pass that fits its model: its own title's words are subtracted."""
    named = comments.where(F.col("t_id").isNotNull())
    return V.term_stats(V.with_bag(named, lower=True, tokens=tokens))


def other_comments(comments: DataFrame, exclude: str | None) -> DataFrame:
    """Comments of all titles but one; those of no title never count."""
    return comments.where(F.col("t_id") != exclude) if exclude is not None else comments.where(F.col("t_id").isNotNull())


def cosine_scores(
    comments: DataFrame,
    review: str,
    exclude: str | None = None,
    max_terms: int = V.MAX_TERMS,
    tokens: str | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Every comment with a positive cosine to the review. The vocabulary is
    fitted on the comments that remain once the reviewed title is left out;
    `stats` are those of all `comments`, if at hand."""
    bags = V.with_bag(other_comments(comments, exclude), lower=True, tokens=tokens)
    if stats is None:
        stats = V.term_stats(bags)
    elif exclude is not None:
        own = V.with_bag(comments.where(F.col("t_id") == exclude), lower=True, tokens=tokens)
        stats = V.without(stats, V.term_stats(own))
    return V.score_one(bags, V.model(stats, max_terms), words_of(review))


def _hit_order() -> list[Column]:
    return [F.col("score").desc(), F.col("t_id"), F.col("comment_pos"), F.col("comment_key")]


def similar_comments(
    comments: DataFrame,
    review: str,
    exclude: str | None = None,
    skip_top: int = SKIP_TOP,
    hits: int = HITS,
    max_terms: int = V.MAX_TERMS,
    tokens: str | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """The comments ranked skip_top+1 .. skip_top+hits by cosine, positive only."""
    scores = cosine_scores(comments, review, exclude, max_terms, tokens, stats)
    return ranked(scores, [], _hit_order(), skip_top + 1, skip_top + hits)


def join_scores(info: DataFrame, scores: DataFrame) -> DataFrame:
    """Title info beside the titles' scores. One review has few; Spark sees their
    number when it runs and broadcasts them then."""
    return info.join(scores, "t_id")


def recommend_titles(
    info: DataFrame,
    comments: DataFrame,
    reviewed: str,
    fav_genres: str | Sequence[str] | None,
    review: str,
    skip_top: int = SKIP_TOP,
    hits: int = HITS,
    titles: int = TITLES,
    max_terms: int = V.MAX_TERMS,
    tokens: str | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """(user_t_id, rank, t_id, score): up to `titles` titles for one review.

    `info` holds one row per t_id; `comments` one row per comment. A favourite
    that is neither text nor a list counts as the default genre. `stats` from
    `corpus_stats` of the same comments save a pass over them."""
    found = similar_comments(comments, review, reviewed, skip_top, hits, max_terms, tokens, stats)
    names = [fav_genres] if isinstance(fav_genres, str) else list(fav_genres or [])
    favs = favourites(F.array(*map(F.lit, names)).cast("array<string>"))
    boosted = join_scores(info.select("t_id", "genre"), max_score_per_title(found)).select(
        F.lit(reviewed).alias("user_t_id"),
        "t_id",
        F.round(genre_boost(F.col("score"), F.col("genre"), favs), V.RANK_DIGITS).alias("score"),
    )
    best = ranked(boosted, ["user_t_id"], [F.col("score").desc(), F.col("t_id")], 1, titles)
    return best.select("user_t_id", "rank", "t_id", "score")


def similar_comments_batch(
    comments: DataFrame,
    reviews: DataFrame,
    fit_on: DataFrame | None = None,
    skip_top: int = SKIP_TOP,
    hits: int = HITS,
    max_terms: int = V.MAX_TERMS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """`similar_comments` for every row of `reviews` (user_id, t_id, review), with
    the reviewed title as `user_t_id`. A reader may review several titles.

    As in the single form, each review's model leaves out the comments of its own
    title; a review of no title has the model of all comments. With
    `fit_on` one model, of those comments, serves all reviews. Not all pairs are
    scored (`leafline.operators.threshold`), and comments are shuffled only
    to fold copies together."""
    named = comments.where(F.col("t_id").isNotNull())  # a comment of no title is excluded everywhere
    titles = reviews.select("t_id" if fit_on is None else F.lit(None).cast("string").alias("t_id")).distinct()
    asked = reviews.select("user_id", "t_id", tokenize(F.col("review"), lower=True).alias("words")).where(F.col("words").isNotNull())
    # nearly always twice the words of a model are enough for all titles
    count, enough = max_terms, False
    while not enough:
        count *= 2
        fitted = fit_titles(named, titles, fit_on, max_terms, count)
        if fitted is None:
            schema = "user_id string, user_t_id string, t_id string, comment_pos int, comment_key string, score double, rank int"
            return comments.sparkSession.createDataFrame([], schema)
        words = materialize(review_words(asked, fitted, fit_on is None), "review-words")
        rounds, n_reviews, enough = review_rounds(words, broadcast_rows)
    return most_similar(fitted, words, rounds, n_reviews, max_terms, skip_top + 1, skip_top + hits)


def recommend_batch(
    info: DataFrame,
    comments: DataFrame,
    reviews: DataFrame,
    fit_on: DataFrame | None = None,
    skip_top: int = SKIP_TOP,
    hits: int = HITS,
    titles: int = TITLES,
    max_terms: int = V.MAX_TERMS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(user_id, user_t_id, rank, t_id, score) for many reviews (user_id, t_id,
    fav_genres, review) at once; a reader has one review of a title."""
    found = similar_comments_batch(comments, reviews, fit_on, skip_top, hits, max_terms, broadcast_rows)
    favs = reviews.select(
        F.col("user_id").alias("__user"), F.col("t_id").alias("__own"), favourites(F.col("fav_genres")).alias("favs")
    )
    mine = F.col("user_id").eqNullSafe(F.col("__user")) & F.col("user_t_id").eqNullSafe(F.col("__own"))
    boosted = (
        max_score_per_title(found, (*REVIEW_KEYS, "t_id"))
        .join(info.select("t_id", "genre"), "t_id")
        .join(favs, mine)
        .select(
            *REVIEW_KEYS,
            "t_id",
            F.round(genre_boost(F.col("score"), F.col("genre"), F.col("favs")), V.RANK_DIGITS).alias("score"),
        )
    )
    best = ranked(boosted, REVIEW_KEYS, [F.col("score").desc(), F.col("t_id")], 1, titles)
    return best.select(*REVIEW_KEYS, "rank", "t_id", "score")
