"""Scans, sinks and keyed tables. Files are written by Spark from the driver's
tables into the shared folder and read back."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafline import schemas as SC
from leafline.functions.dates import COMPACT, DASHED
from leafline.session import scratch_path
from leafline.sources import buckets as B
from leafline.sources import drift as DR
from leafline.sources import sinks as K
from leafline.sources import snapshots as S
from leafline.sources import upsert as U
from suite.raw import ANCHOR, RAW_K_SQL, RAW_N_SQL, raw_k, raw_n
from suite.registry import case, table


def _write_days(df, spark, pattern: str) -> str:
    """One folder `file=<day>.json` per day; returns the prefix of the day."""
    base = scratch_path(spark, "days")
    named = df.withColumn("file", F.concat(F.date_format("snapshot_date", pattern), F.lit(".json")))
    K.write_json(named.drop("snapshot_date"), base, ["file"])
    return base + "/file="


_N_TEXT = """t_IDs, t_names, t_auth, t_genre, array_to_string(t_weekdays, '|') AS t_weekdays,
  array_to_string(t_comments, '|') AS t_comments, snapshot_date::VARCHAR AS day"""


def _n_text(df):
    return df.select(
        "t_IDs", "t_names", "t_auth", "t_genre", F.array_join("t_weekdays", "|").alias("t_weekdays"),
        F.array_join("t_comments", "|").alias("t_comments"), F.col("snapshot_date").cast("string").alias("day"),
    )


@case(f"""SELECT id, title, story_line, array_to_string(best_comments, '|') AS best_comments,
  snapshot_date::VARCHAR AS day FROM ({RAW_K_SQL})""")
def scan_json_dashed(spark, sf):
    # 35 days back: the table holds 30 days, the rest are missing and skipped
    days = S.scan_lookback(spark, _write_days(raw_k(spark, sf), spark, "yyyy-MM-dd"), SC.K_JSON, ANCHOR, DASHED, 35)
    return days.select(
        "id", "title", "story_line", F.array_join("best_comments", "|").alias("best_comments"),
        F.col("snapshot_date").cast("string").alias("day"),
    )


@case(f"SELECT {_N_TEXT} FROM ({RAW_N_SQL}) WHERE snapshot_date >= DATE '{ANCHOR}' - 5")
def scan_json_compact(spark, sf):
    days = S.scan_lookback(spark, _write_days(raw_n(spark, sf), spark, "yyyyMMdd"), SC.N_RUNNING, ANCHOR, COMPACT)
    return _n_text(days)


@case(f"""SELECT event_id, user_id, event_type FROM events
  WHERE ts >= TIMESTAMP '{ANCHOR}' - INTERVAL 5 DAY AND ts < TIMESTAMP '{ANCHOR}' + INTERVAL 1 DAY""")
def snapshot_lookback(spark, sf):
    return S.lookback(table(spark, sf, "events"), ANCHOR, on="ts").select("event_id", "user_id", "event_type")


@case("SELECT event_id, user_id, event_type FROM events WHERE ts::DATE = DATE '2024-03-05' - 50")
def snapshot_at_offset(spark, sf):
    return S.at_offset(table(spark, sf, "events"), date(2024, 3, 5), on="ts").select("event_id", "user_id", "event_type")


@case("SELECT ts::DATE::VARCHAR AS day, count(*) AS n_rows FROM events GROUP BY 1")
def snapshot_counts(spark, sf):
    events = table(spark, sf, "events").select(F.to_date("ts").alias("snapshot_date"))
    return S.snapshot_counts(events).select(F.col("snapshot_date").cast("string").alias("day"), "n_rows")


_LINE_SQL = """'{"t_IDs":"' || event_id || '","t_names":"' || event_type || '"}'"""


@case(f"""SELECT CASE WHEN event_type = 'error' THEN '<broken>' ELSE event_id::VARCHAR END AS t_id,
  CASE WHEN event_type = 'error' THEN left({_LINE_SQL}, 12) ELSE event_type END AS content FROM events""")
def corrupt_record_split(spark, sf):
    whole = F.to_json(F.struct(F.col("event_id").cast("string").alias("t_IDs"), F.col("event_type").alias("t_names")))
    lines = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", F.substring(whole, 1, 12)).otherwise(whole).alias("value"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("file"),
    )
    base = scratch_path(spark, "lines")
    lines.write.partitionBy("file").text(base)
    days = S.scan_lookback(spark, base + "/file=", SC.N_FINISHED, ANCHOR, COMPACT, 29, keep_corrupt=True)
    good, bad = S.split_corrupt(days)
    return good.select(F.col("t_IDs").alias("t_id"), F.col("t_names").alias("content")).unionByName(
        bad.select(F.coalesce("t_IDs", F.lit("<broken>")).alias("t_id"), F.col(SC.CORRUPT).alias("content"))
    )


@case(f"SELECT {_N_TEXT} FROM ({RAW_N_SQL})")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    K.write_json(raw_n(spark, sf), path)
    return _n_text(spark.read.schema(SC.dated(SC.N_RUNNING)).json(path))


@case("SELECT doc_id::VARCHAR AS serial, text AS story_line, source || '|' || lang AS key_words FROM documents")
def csv_roundtrip(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("serial"), F.col("text").alias("story_line"),
                       F.array("source", "lang").alias("key_words"))
    path = scratch_path(spark, "csv")
    K.write_csv(rows, path)
    back = K.read_csv(spark, path, K.lists_as_json(rows).schema)
    return back.select("serial", "story_line", F.array_join(K.parse_list(F.col("key_words")), "|").alias("key_words"))


def _crawled(spark, sf: str):
    """Documents as rows of a weekday crawl, lists as Python prints them."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("serial"),
        F.concat(F.lit("/content/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("").alias("pic"),
        F.col("lang").alias("genre"),
        F.lit("1.2m").alias("view"),
        F.lit("10k").alias("like"),
        F.lit("on").alias("on_serial"),
        F.lit("['mon', 'tue']").alias("day"),
        F.col("source").alias("title"),
        F.col("lang").alias("story_writer"),
        F.col("source").alias("illustrator"),
        F.lit("p").alias("publisher"),
        F.col("text").alias("story_line"),
        F.format_string("['%s', \"it's %s\"]", "source", "lang").alias("key_words"),
        F.lit("[]").alias("best_comments"),
    )


@case("""SELECT doc_id::VARCHAR AS id, '<none>' AS picUrl, source AS title, text AS story_line, 'mon|tue' AS day,
  source || '|it''s ' || lang AS key_words, 0::BIGINT AS n_comments FROM documents""")
def csv_to_snapshot(spark, sf):
    path = scratch_path(spark, "crawl")
    _crawled(spark, sf).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return K.read_weekday_csv(spark, path).select(
        "id", F.coalesce("picUrl", F.lit("<none>")).alias("picUrl"), "title", "story_line",
        F.array_join("day", "|").alias("day"), F.array_join("key_words", "|").alias("key_words"),
        F.size("best_comments").cast("long").alias("n_comments"),
    )


@case("""SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
  UNION ALL SELECT s_suppkey, s_name, '<none>' FROM supplier""")
def union_missing_cols(spark, sf):
    weekday = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    completed = table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    return K.union_shapes(weekday, completed).withColumn("segment", F.coalesce("segment", F.lit("<none>")))


@case("""WITH new AS (SELECT user_id AS key, event_type AS item, event_id AS version FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
  SELECT key, item, version::VARCHAR AS version FROM new
  UNION ALL SELECT c_custkey, c_name, '0' FROM customer WHERE c_custkey NOT IN (SELECT key FROM new)""")
def keyed_upsert(spark, sf):
    base = scratch_path(spark, "items")
    stored = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS item", "0L AS version")
    U.publish(stored, base, 1)
    updates = table(spark, sf, "events").selectExpr("user_id AS key", "event_type AS item", "event_id AS version")
    U.publish(U.upsert(U.read_version(spark, base, 1), updates, "key", [F.col("version").desc()]), base, 2)
    return U.read_version(spark, base, 2).withColumn("version", F.col("version").cast("string"))


@case("""WITH new AS (SELECT user_id AS key, event_type AS item, event_id AS version FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
  SELECT key, item, version::VARCHAR AS version FROM new
  UNION ALL SELECT c_custkey, c_name, '0' FROM customer WHERE c_custkey NOT IN (SELECT key FROM new)""")
def bucketed_upsert(spark, sf):
    """The same, with only touched buckets written again."""
    base = scratch_path(spark, "buckets")
    stored = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS item", "0L AS version")
    B.upsert_bucketed(spark, base, stored, "key", buckets=32)
    updates = table(spark, sf, "events").selectExpr("user_id AS key", "event_type AS item", "event_id AS version")
    B.upsert_bucketed(spark, base, updates, "key", [F.col("version").desc()])
    return B.read_bucketed(spark, base).withColumn("version", F.col("version").cast("string"))


@case("""SELECT p_partkey, to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_size': p_size})::VARCHAR AS item FROM part""")
def row_to_item(spark, sf):
    return U.to_items(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")


@case("""SELECT event_type AS dataset, lower(strftime(ts, '%a')) AS weekday, ts::DATE::VARCHAR AS day, event_id FROM events""")
def partitioned_write(spark, sf):
    path = scratch_path(spark, "datasets")
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("dataset"), F.lower(F.date_format("ts", "E")).alias("weekday"),
        F.to_date("ts").alias("snapshot_date"), "event_id",
    )
    K.write_partitioned(events, path)
    back = spark.read.schema(events.schema).parquet(path)
    return back.select("dataset", "weekday", F.col("snapshot_date").cast("string").alias("day"), "event_id")


def _drifting(spark, sf):
    """Every third day has ids as numbers, every seventh names under another name that is known,
    and every fifth authors under one that is not."""
    day = F.dayofmonth("snapshot_date")
    keep = ["t_weekdays", "t_comments"]
    t_id, name, auth = F.col("t_IDs"), F.col("t_names"), F.col("t_auth")

    def text(*cols):
        return F.to_json(F.struct(*cols, *keep))

    value = (
        F.when(day % 3 == 0, text(t_id.cast("long").alias("t_IDs"), name, auth))
        .when(day % 7 == 0, text(t_id, name.alias("names"), auth))
        .when(day % 5 == 0, text(t_id, name, auth.alias("writer")))
        .otherwise(text(t_id, name, auth))
    )
    base = scratch_path(spark, "drifting")
    file = F.concat(F.date_format("snapshot_date", "yyyyMMdd"), F.lit(".json"))
    raw_n(spark, sf).select(file.alias("file"), value.alias("value")).write.partitionBy("file").text(base)
    wanted = StructType([f for f in SC.N_RUNNING if f.name in ("t_IDs", "t_names", "t_auth", *keep)])
    return DR.scan_drifting(spark, base + "/file=", wanted, ANCHOR, COMPACT, 30, aliases={"t_names": ["names"]})


_RENAMED = "day(snapshot_date) % 3 <> 0 AND day(snapshot_date) % 7 <> 0 AND day(snapshot_date) % 5 = 0"


@case(f"""SELECT t_IDs, t_names, t_auth, array_to_string(t_weekdays, '|') AS t_weekdays,
  array_to_string(t_comments, '|') AS t_comments, snapshot_date::VARCHAR AS day
  FROM ({RAW_N_SQL}) WHERE snapshot_date BETWEEN DATE '{ANCHOR}' - 30 AND DATE '{ANCHOR}' AND NOT ({_RENAMED})""")
def drifting_days(spark, sf):
    return _n_text(_drifting(spark, sf).rows.withColumn("t_genre", F.lit(None))).drop("t_genre")


@case(f"""SELECT snapshot_date::VARCHAR AS day, 'missing t_auth; unknown writer' AS reason, count(*) AS n
  FROM ({RAW_N_SQL}) WHERE snapshot_date BETWEEN DATE '{ANCHOR}' - 30 AND DATE '{ANCHOR}' AND {_RENAMED} GROUP BY 1""")
def drift_rejects(spark, sf):
    rejects = _drifting(spark, sf).rejects.groupBy(F.col("snapshot_date").cast("string").alias("day"), "reason")
    return rejects.agg(F.count(F.lit(1)).alias("n"))
