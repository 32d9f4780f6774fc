"""Raw daily records of both sites, derived from `events` and `lineitem`.

Each event is one record of its day on site N (title = user). Site K's records
come from events too, under other columns: its title is the event's `k` property.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import table

ANCHOR = date(2024, 1, 30)


def _events(spark, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))


def raw_n(spark, sf: str) -> DataFrame:
    e = _events(spark, sf).withColumn("t_IDs", F.col("user_id").cast("string"))
    return e.select(
        "t_IDs",
        F.array(F.lower(F.date_format("ts", "E")), F.lit("sun")).alias("t_weekdays"),
        F.concat(F.lit("title "), "t_IDs").alias("t_names"),
        F.concat("event_type", F.lit(" / "), F.col("event_id").cast("string")).alias("t_auth"),
        F.concat("event_type", F.lit(", "), F.date_format("ts", "yyyy")).alias("t_genre"),
        F.lit("12").alias("t_age"),
        F.col("props").alias("t_sum"),
        F.concat(F.lit("/img/"), F.col("event_id").cast("string")).alias("t_thumbs"),
        F.concat(F.lit("/list?titleId="), "t_IDs").alias("t_urls"),
        F.when(F.col("event_type") == "error", F.array().cast("array<string>"))
        .otherwise(F.array("props", "event_type"))
        .alias("t_comments"),
        "snapshot_date",
    )


RAW_N_SQL = """SELECT user_id::VARCHAR AS t_IDs, [lower(strftime(ts, '%a')), 'sun'] AS t_weekdays,
  'title ' || user_id AS t_names, event_type || ' / ' || event_id AS t_auth,
  event_type || ', ' || strftime(ts, '%Y') AS t_genre, '12' AS t_age, props AS t_sum, '/img/' || event_id AS t_thumbs,
  '/list?titleId=' || user_id AS t_urls,
  CASE WHEN event_type = 'error' THEN []::VARCHAR[] ELSE [props, event_type] END AS t_comments, ts::DATE AS snapshot_date
  FROM events"""


def finished_n(spark, sf: str) -> DataFrame:
    return raw_n(spark, sf).drop("t_weekdays", "t_comments")


RAW_F_SQL = f"SELECT * EXCLUDE (t_weekdays, t_comments) FROM ({RAW_N_SQL})"


def raw_k(spark, sf: str) -> DataFrame:
    e = _events(spark, sf).withColumn("id", F.expr("get_json_object(props, '$.k')"))
    return e.select(
        "id",
        F.concat(F.lit("/content/"), "id").alias("url"),
        F.concat(F.lit("/pic/"), F.col("event_id").cast("string")).alias("picUrl"),
        F.concat("event_type", F.lit("/"), F.date_format("ts", "MM")).alias("genre"),
        F.array(F.lower(F.date_format("ts", "E"))).alias("day"),
        F.concat(F.lit("content "), "id").alias("title"),
        F.col("event_type").alias("story_writer"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
        .when(F.col("event_id") % 3 == 1, F.col("user_id").cast("string"))
        .alias("illustrator"),
        F.col("props").alias("story_line"),
        F.array("event_type").alias("key_words"),
        F.array("event_type", "props").alias("best_comments"),
        "snapshot_date",
    )


RAW_K_SQL = """SELECT id, '/content/' || id AS url, '/pic/' || event_id AS picUrl,
  event_type || '/' || strftime(ts, '%m') AS genre, [lower(strftime(ts, '%a'))] AS day, 'content ' || id AS title,
  event_type AS story_writer,
  CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN user_id::VARCHAR END AS illustrator, props AS story_line,
  [event_type] AS key_words, [event_type, props] AS best_comments, snapshot_date
  FROM (SELECT *, json_extract_string(props, '$.k') AS id, ts::DATE AS snapshot_date FROM events)"""
