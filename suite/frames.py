"""The driver's tables in the shapes the operators work on, with the same shape
in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.registry import table


def conversation_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comment per turn; a conversation is a title."""
    t = table(spark, sf_dir, "conversations")
    return t.select(
        F.concat(F.lit("N"), F.col("conv_id").cast("string")).alias("t_id"),
        F.col("turn").alias("comment_pos"),
        F.col("text").alias("comment"),
    )


COMMENTS_SQL = "SELECT 'N' || conv_id AS t_id, turn AS comment_pos, text AS comment FROM conversations"


def document_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comment per document; a source is a title."""
    t = table(spark, sf_dir, "documents")
    return t.select(F.col("source").alias("t_id"), F.col("doc_id").alias("comment_pos"), F.col("text").alias("comment"))


DOCUMENTS_SQL = "SELECT source AS t_id, doc_id AS comment_pos, text AS comment FROM documents"


def part_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part")
    return t.select(
        F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("t_id"),
        F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(0).alias("site"),
        F.col("p_name").alias("title"),
        F.split("p_name", " ").alias("genre"),
    )


INFO_SQL = """SELECT 'N' || p_partkey AS t_id, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS site,
  p_name AS title, string_split(p_name, ' ') AS genre FROM part"""


def benchmark_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "benchmark")
    return t.select(
        F.concat(F.lit("u"), F.expr("item_id div 2").cast("string")).alias("user_id"),  # a reader reviews two titles
        F.concat(F.lit("N"), F.col("item_id").cast("string")).alias("t_id"),
        F.when(F.col("item_id") % 3 == 0, F.array(F.lit("red"), F.lit("small")))
        .when(F.col("item_id") % 3 == 1, F.array(F.lit("ring")))
        .alias("fav_genres"),
        F.col("text").alias("review"),
    )


REVIEWS_SQL = """SELECT 'u' || (item_id // 2) AS user_id, 'N' || item_id AS t_id,
  CASE item_id % 3 WHEN 0 THEN ['red', 'small'] WHEN 1 THEN ['ring'] ELSE ['스토리'] END AS favs, text AS review
  FROM benchmark"""


def words_sql(source: str, keys: str = "t_id, comment_pos", lower: bool = True, text: str = "comment") -> str:
    """One row per word occurrence of `source`."""
    body = f"lower({text})" if lower else text
    return f"SELECT {keys}, unnest(regexp_extract_all({body}, '[A-Za-z0-9가-힣]{{2,}}')) AS term FROM ({source})"


def bag_sql(source: str, keys: str = "t_id, comment_pos", lower: bool = True, text: str = "comment") -> str:
    return f"SELECT {keys}, term, count(*) AS n FROM ({words_sql(source, keys, lower, text)}) GROUP BY ALL"


def vocabulary_ctes(source: str, max_terms: int = 2000) -> str:
    """CTEs docs, bag, vocab(term, tf, df, n_docs, idf) over `source`."""
    return f"""docs AS ({source}),
  bag AS ({bag_sql('SELECT * FROM docs')}),
  vocab AS (SELECT term, tf, df, n_docs, ln((1 + n_docs)::DOUBLE / (1 + df)) + 1 AS idf
    FROM (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM bag GROUP BY term ORDER BY tf DESC, term LIMIT {max_terms})
    CROSS JOIN (SELECT count(*) AS n_docs FROM docs))"""


def vectors_ctes() -> str:
    """CTE vectors(t_id, comment_pos, term, w) after `vocabulary_ctes`."""
    return """raw AS (SELECT t_id, comment_pos, term, n * idf AS w FROM bag JOIN vocab USING (term)),
  vectors AS (SELECT t_id, comment_pos, term, w / sqrt(sum(w * w) OVER (PARTITION BY t_id, comment_pos)) AS w FROM raw)"""


def hits_ctes(review_source: str, comment_source: str | None = None) -> str:
    """CTEs down to scores(user_id, t_id, comment_pos, score) and ranked hits."""
    exclude = "v.t_id <> r.own"
    return f"""reviews AS ({review_source}),
  rbag AS (SELECT user_id, own, term, count(*) AS n FROM (
    SELECT user_id, t_id AS own, unnest(regexp_extract_all(lower(review), '[A-Za-z0-9가-힣]{{2,}}')) AS term FROM reviews)
    GROUP BY ALL),
  rraw AS (SELECT user_id, own, term, n * idf AS w FROM rbag JOIN vocab USING (term)),
  rvec AS (SELECT user_id, own, term, w / sqrt(sum(w * w) OVER (PARTITION BY user_id, own)) AS w FROM rraw),
  scores AS (SELECT r.user_id, r.own, v.t_id, v.comment_pos, round(sum(v.w * r.w), 9) AS score
    FROM vectors v JOIN rvec r ON v.term = r.term AND {exclude} GROUP BY ALL HAVING sum(v.w * r.w) > 0),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, own ORDER BY score DESC, t_id, comment_pos) AS rank FROM scores),
  hits AS (SELECT * FROM numbered WHERE rank BETWEEN 2 AND 21)"""


def own_models_ctes(source: str, review_source: str, max_terms: int = 2000) -> str:
    """CTEs down to scores and ranked hits, as `hits_ctes`, with a model for each
    reviewed title, fitted on the comments of all others."""
    return f"""docs AS ({source}), reviews AS ({review_source}),
  bag AS ({bag_sql('SELECT * FROM docs')}),
  base AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM bag GROUP BY term),
  titles AS (SELECT t_id AS own, (SELECT count(*) FROM docs) - (SELECT count(*) FROM docs d WHERE d.t_id = r.t_id) AS n_docs
    FROM (SELECT DISTINCT t_id FROM reviews) r),
  owned AS (SELECT t_id AS own, term, sum(n)::BIGINT AS tf, count(*) AS df FROM bag WHERE t_id IN (SELECT own FROM titles) GROUP BY ALL),
  mine AS (SELECT own, n_docs, term, base.tf - coalesce(owned.tf, 0) AS tf, base.df - coalesce(owned.df, 0) AS df
    FROM titles CROSS JOIN base LEFT JOIN owned USING (own, term)),
  vocab AS (SELECT own, term, ln((1 + n_docs)::DOUBLE / (1 + df)) + 1 AS idf FROM mine WHERE df > 0
    QUALIFY row_number() OVER (PARTITION BY own ORDER BY tf DESC, term) <= {max_terms}),
  raw AS (SELECT own, t_id, comment_pos, term, n * idf AS w FROM bag JOIN vocab USING (term) WHERE t_id <> own),
  vectors AS (SELECT own, t_id, comment_pos, term, w / sqrt(sum(w * w) OVER (PARTITION BY own, t_id, comment_pos)) AS w FROM raw),
  rbag AS (SELECT user_id, own, term, count(*) AS n FROM (
    SELECT user_id, t_id AS own, unnest(regexp_extract_all(lower(review), '[A-Za-z0-9가-힣]{{2,}}')) AS term FROM reviews)
    GROUP BY ALL),
  rraw AS (SELECT user_id, own, term, n * idf AS w FROM rbag JOIN vocab USING (own, term)),
  rvec AS (SELECT user_id, own, term, w / sqrt(sum(w * w) OVER (PARTITION BY user_id, own)) AS w FROM rraw),
  scores AS (SELECT r.user_id, r.own, v.t_id, v.comment_pos, round(sum(v.w * r.w), 9) AS score
    FROM vectors v JOIN rvec r ON v.own = r.own AND v.term = r.term GROUP BY ALL HAVING sum(v.w * r.w) > 0),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, own ORDER BY score DESC, t_id, comment_pos) AS rank FROM scores),
  hits AS (SELECT * FROM numbered WHERE rank BETWEEN 2 AND 21)"""


def one_review_sql() -> str:
    """The text of conversation 0, turn 1, as the review of title N0."""
    return """SELECT 'N0' AS user_id, 'N0' AS t_id, ['red', 'small'] AS favs, text AS review
    FROM conversations WHERE conv_id = 0 AND turn = 1"""


def one_review(spark: SparkSession, sf_dir: str) -> str:
    row = table(spark, sf_dir, "conversations").where("conv_id = 0 and turn = 1").select("text").first()
    return row["text"] if row else ""
