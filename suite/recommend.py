"""Scores, hits and recommended titles."""

from pyspark.sql import functions as F

from leafline.operators import ranking as R
from leafline.plans import recommend as P
from suite.frames import (
    COMMENTS_SQL,
    INFO_SQL,
    REVIEWS_SQL,
    benchmark_reviews,
    conversation_comments,
    hits_ctes,
    one_review,
    one_review_sql,
    own_models_ctes,
    part_info,
    vectors_ctes,
    vocabulary_ctes,
)
from suite.registry import case, table

OTHERS_SQL = f"SELECT * FROM ({COMMENTS_SQL}) WHERE t_id <> 'N0'"
ONE = f"WITH {vocabulary_ctes(OTHERS_SQL)}, {vectors_ctes()}, {hits_ctes(one_review_sql())}"
MANY = f"WITH {own_models_ctes(COMMENTS_SQL, REVIEWS_SQL)}"
SHARED = f"WITH {vocabulary_ctes(COMMENTS_SQL)}, {vectors_ctes()}, {hits_ctes(REVIEWS_SQL)}"
TOP = f"""best AS (SELECT user_id, own, t_id, max(score) AS score FROM hits GROUP BY ALL),
  boosted AS (SELECT b.user_id, b.own, b.t_id,
      round(CASE WHEN len(list_intersect(i.genre, r.favs)) > 0 THEN b.score * 1.3 ELSE b.score END, 9) AS score
    FROM best b JOIN ({INFO_SQL}) i USING (t_id) JOIN reviews r ON b.user_id = r.user_id AND b.own = r.t_id),
  placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, own ORDER BY score DESC, t_id) AS rank FROM boosted)"""


@case(f"{ONE} SELECT t_id, comment_pos, round(score, 6) AS score FROM scores")
def cosine_scores(spark, sf):
    scores = P.cosine_scores(conversation_comments(spark, sf), one_review(spark, sf), "N0")
    return scores.select("t_id", "comment_pos", F.round("score", 6).alias("score"))


@case(f"{ONE} SELECT t_id, comment_pos, round(score, 6) AS score, rank FROM hits")
def similar_comments(spark, sf):
    hits = P.similar_comments(conversation_comments(spark, sf), one_review(spark, sf), "N0")
    return hits.select("t_id", "comment_pos", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@case(f"{ONE}, {TOP} SELECT user_id AS user_t_id, rank, t_id, round(score, 6) AS score FROM placed WHERE rank <= 5")
def recommend_titles(spark, sf):
    best = P.recommend_titles(
        part_info(spark, sf), conversation_comments(spark, sf), "N0", ["red", "small"], one_review(spark, sf)
    )
    return best.select("user_t_id", F.col("rank").cast("long").alias("rank"), "t_id", F.round("score", 6).alias("score"))


@case(f"{MANY}, {TOP} SELECT user_id, own AS user_t_id, rank, t_id, round(score, 6) AS score FROM placed WHERE rank <= 5")
def recommend_batch(spark, sf):
    best = P.recommend_batch(part_info(spark, sf), conversation_comments(spark, sf), benchmark_reviews(spark, sf))
    return best.select("user_id", "user_t_id", F.col("rank").cast("long").alias("rank"), "t_id", F.round("score", 6).alias("score"))


@case(f"{MANY} SELECT user_id, own AS user_t_id, t_id, comment_pos, round(score, 6) AS score, rank FROM hits")
def ranked_hits(spark, sf):
    hits = P.similar_comments_batch(conversation_comments(spark, sf), benchmark_reviews(spark, sf))
    return hits.select(
        "user_id", "user_t_id", "t_id", "comment_pos", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")
    )


@case(f"{SHARED} SELECT user_id, own AS user_t_id, t_id, comment_pos, round(score, 6) AS score, rank FROM hits")
def ranked_hits_shared_model(spark, sf):
    """One model of all comments for all reviews."""
    comments = conversation_comments(spark, sf)
    hits = P.similar_comments_batch(comments, benchmark_reviews(spark, sf), fit_on=comments)
    return hits.select(
        "user_id", "user_t_id", "t_id", "comment_pos", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")
    )


@case(f"""WITH {vocabulary_ctes(COMMENTS_SQL)}, rbag AS (SELECT user_id, user_t_id, term, count(*) AS n FROM (
    SELECT user_id, t_id AS user_t_id, unnest(regexp_extract_all(lower(review), '[A-Za-z0-9가-힣]{{2,}}')) AS term FROM ({REVIEWS_SQL}))
    GROUP BY ALL), rraw AS (SELECT user_id, user_t_id, term, n * idf AS w FROM rbag JOIN vocab USING (term))
  SELECT user_id, user_t_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY user_id, user_t_id)), 6) AS weight FROM rraw""")
def review_tfidf(spark, sf):
    words = P.review_tfidf(conversation_comments(spark, sf), benchmark_reviews(spark, sf))
    return words.select("user_id", "user_t_id", "term", F.round("weight", 6).alias("weight"))


@case(f"SELECT t_id, comment_pos FROM ({OTHERS_SQL})")
def exclude_self(spark, sf):
    return P.other_comments(conversation_comments(spark, sf), "N0").select("t_id", "comment_pos")


@case("""SELECT p_partkey, round(CASE WHEN list_contains(string_split(p_name, ' '), 'red')
  THEN p_retailprice * 1.3 ELSE p_retailprice END, 6) AS score FROM part""")
def genre_boost(spark, sf):
    boosted = R.genre_boost(F.col("p_retailprice"), F.split("p_name", " "), F.array(F.lit("red")))
    return table(spark, sf, "part").select("p_partkey", F.round(boosted, 6).alias("score"))


@case("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_partkey % 3 = 1 THEN '스토리'
  ELSE p_name || '|' || p_brand END AS favs FROM part""")
def favourite_genre(spark, sf):
    given = (
        F.when(F.col("p_partkey") % 3 == 0, F.array("p_type"))
        .when(F.col("p_partkey") % 3 == 1, F.array().cast("array<string>"))
        .otherwise(F.array("p_name", "p_brand"))
    )
    return table(spark, sf, "part").select("p_partkey", F.array_join(R.favourites(given), "|").alias("favs"))


@case(f"""SELECT i.t_id, i.title, i.site, round(s.score, 6) AS score FROM ({INFO_SQL}) i
  JOIN (SELECT 'N' || conv_id AS t_id, max(length(text))::DOUBLE AS score FROM conversations GROUP BY 1) s USING (t_id)""")
def info_join_scores(spark, sf):
    scores = R.max_score_per_title(
        conversation_comments(spark, sf).select("t_id", F.length("comment").cast("double").alias("score"))
    )
    return P.join_scores(part_info(spark, sf), scores).select("t_id", "title", "site", F.round("score", 6).alias("score"))


@case("SELECT 'N' || conv_id AS t_id, max(length(text))::BIGINT AS score FROM conversations GROUP BY 1")
def max_score_per_title(spark, sf):
    lengths = conversation_comments(spark, sf).select("t_id", F.length("comment").cast("long").alias("score"))
    return R.max_score_per_title(lengths)


@case("SELECT role, text, min(turn) AS rank FROM conversations GROUP BY ALL")
def dedup_keep_best(spark, sf):
    return R.dedup_keep_best(table(spark, sf, "conversations").withColumnRenamed("turn", "rank"), ["role", "text"])


@case("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def top5_titles(spark, sf):
    return R.top(
        table(spark, sf, "part").select("p_partkey", "p_retailprice"),
        [F.col("p_retailprice").desc(), F.col("p_partkey")],
        5,
    )


@case("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 1")
def offset_limit(spark, sf):
    return R.offset_limit(
        table(spark, sf, "part").select("p_partkey", "p_retailprice"),
        [F.col("p_retailprice").desc(), F.col("p_partkey")],
        1,
        20,
    )
