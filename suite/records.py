"""Canonical tables from raw records."""

from datetime import date

from pyspark.sql import functions as F

from leafline.functions import fields as X
from leafline.operators import records as R
from leafline.operators.ranking import latest_per_key as newest
from leafline.plans import catalog as C
from leafline.sources import snapshots as S
from suite.raw import ANCHOR, RAW_F_SQL, RAW_K_SQL, RAW_N_SQL, finished_n, raw_k, raw_n
from suite.registry import case, table


def _flat(df):
    """Arrays as text, so that both engines compare the same way."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


@case("SELECT user_id, event_type, 'K' || user_id AS t_id, event_id FROM events")
def key_prefix_sql(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return R.key_prefix_sql(events, "K", "user_id")


@case("SELECT 'N' || user_id AS t_index, event_type, event_id FROM events")
def key_prefix_df(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("t_IDs"), "event_type", "event_id")
    return R.key_prefix(events, "N", "t_IDs")


@case("SELECT event_id, event_type, props FROM events")
def project_sql(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("raw_events")
    return R.project_sql(spark, "raw_events", "event_id", "event_type", "props")


@case("SELECT p_partkey, p_name, p_size, round(p_retailprice, 6) AS p_retailprice FROM part")
def drop_columns(spark, sf):
    return table(spark, sf, "part").drop("p_brand", "p_type").withColumn("p_retailprice", F.round("p_retailprice", 6))


@case("SELECT p_name, p_partkey, p_type, p_brand FROM part")
def reorder_columns(spark, sf):
    return R.reorder(table(spark, sf, "part"), ["p_name", "p_partkey", "p_type", "p_brand"])


_N_COLUMNS = """'N' || t_IDs AS t_id, 1 AS site, t_names AS title, array_to_string(t_weekdays, '|') AS weekdays,
  t_auth AS author, array_to_string(string_split(t_genre, ', '), '|') AS genre, t_sum AS story_line, t_thumbs AS thumb,
  t_urls AS url"""
_F_COLUMNS = """'N' || t_IDs AS t_id, 1 AS site, t_names AS title, t_auth AS author,
  array_to_string(string_split(t_genre, ', '), '|') AS genre, t_sum AS story_line, t_thumbs AS thumb, t_urls AS url"""
_K_COLUMNS = """'K' || id AS t_id, 0 AS site, title, array_to_string(day, '|') AS weekdays,
  CASE WHEN illustrator = story_writer THEN illustrator ELSE story_writer || '/' || illustrator END AS author,
  array_to_string(string_split(genre, '/'), '|') AS genre, story_line, picUrl AS thumb, url"""


@case(f"SELECT {_N_COLUMNS} FROM ({RAW_N_SQL})")
def canonical_running_n(spark, sf):
    return _flat(R.rename(R.prepare_n(raw_n(spark, sf)), R.RUNNING_N))


@case(f"SELECT * REPLACE (coalesce(author, '<none>') AS author) FROM (SELECT {_K_COLUMNS} FROM ({RAW_K_SQL}))")
def canonical_running_k(spark, sf):
    info = _flat(R.rename(R.prepare_k(raw_k(spark, sf)), R.RUNNING_K))
    return info.withColumn("author", F.coalesce("author", F.lit("<none>")))


@case(f"SELECT {_F_COLUMNS} FROM ({RAW_F_SQL})")
def canonical_finished(spark, sf):
    return _flat(R.rename(R.prepare_n(finished_n(spark, sf), running=False), R.FINISHED_N))


_N_COMMENTS = f"SELECT 'N' || t_IDs AS t_id, array_to_string(t_comments, '|') AS best_comments FROM ({RAW_N_SQL})"
_K_COMMENTS = f"SELECT 'K' || id AS t_id, array_to_string(best_comments, '|') AS best_comments FROM ({RAW_K_SQL})"


@case(_N_COMMENTS)
def comment_projection(spark, sf):
    return _flat(R.rename(R.key_prefix(raw_n(spark, sf), "N", "t_IDs"), R.COMMENTS_N))


@case("SELECT s_suppkey AS key, 1 AS site FROM supplier UNION ALL SELECT c_custkey, 0 FROM customer")
def site_tag(spark, sf):
    n = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key")).withColumn("site", F.lit(X.N_SITE))
    k = table(spark, sf, "customer").select(F.col("c_custkey").alias("key")).withColumn("site", F.lit(X.K_SITE))
    return R.union_sites(n, k)


@case(f"SELECT t_IDs, snapshot_date::VARCHAR AS day, len(t_comments)::BIGINT AS n FROM ({RAW_N_SQL}) WHERE len(t_comments) > 0")
def nonempty_comments(spark, sf):
    kept = R.nonempty_comments(raw_n(spark, sf), "t_comments")
    return kept.select(
        "t_IDs", F.col("snapshot_date").cast("string").alias("day"), F.size("t_comments").cast("long").alias("n")
    )


@case("SELECT c_custkey, c_name FROM customer WHERE TRY_CAST(c_acctbal::VARCHAR AS DOUBLE) >= 5000")
def rating_filter(spark, sf):
    customers = table(spark, sf, "customer")
    return customers.where(X.at_least(F.col("c_acctbal").cast("string"), 5000.0)).select("c_custkey", "c_name")


@case("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts::DATE DESC, event_id) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.to_date("ts").alias("snapshot_date"))
    return newest(events, "user_id", [F.col("snapshot_date").desc(), "event_id"]).drop("snapshot_date")


@case("SELECT DISTINCT p_name, p_brand, p_type FROM part")
def distinct_rows(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_brand", "p_type").distinct()


@case("SELECT user_id, event_id, event_type FROM events")
def union_days(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.dayofmonth("ts").alias("d"))
    thirds = [events.where(F.col("d") % 3 == i).drop("d") for i in range(3)]
    return S.union_days(thirds[0], thirds[1].select("event_type", "event_id", "user_id"), thirds[2])


@case("""SELECT 'N' || s_suppkey AS t_id, 1 AS site, s_name AS title FROM supplier
  UNION ALL SELECT 'K' || c_custkey, 0, c_name FROM customer""")
def union_sites_info(spark, sf):
    n = table(spark, sf, "supplier").select(
        X.title_key("N", F.col("s_suppkey").cast("string")).alias("t_id"), F.lit(X.N_SITE).alias("site"),
        F.col("s_name").alias("title"),
    )
    k = table(spark, sf, "customer").select(
        F.col("c_name").alias("title"), F.lit(X.K_SITE).alias("site"),
        X.title_key("K", F.col("c_custkey").cast("string")).alias("t_id"),
    )
    return R.union_sites(n, k)


@case(f"{_N_COMMENTS} UNION ALL {_K_COMMENTS}")
def union_sites_comments(spark, sf):
    n = R.rename(R.key_prefix(raw_n(spark, sf), "N", "t_IDs"), R.COMMENTS_N)
    k = R.rename(R.key_prefix(raw_k(spark, sf), "K", "id", "t_id"), R.COMMENTS_K)
    return _flat(R.union_sites(n, k))


def _window(raw: str, anchor: date, back: int = 5) -> str:
    return f"SELECT * FROM ({raw}) WHERE snapshot_date BETWEEN DATE '{anchor}' - {back} AND DATE '{anchor}'"


def _newest_sql(columns: str, raw: str, running: bool = True) -> str:
    content = ["site", "title", *(["weekdays"] if running else []), "author", "genre", "story_line", "thumb", "url"]
    return f"""SELECT * EXCLUDE (r, snapshot_date) FROM (SELECT *, row_number() OVER (PARTITION BY t_id
      ORDER BY snapshot_date DESC, {', '.join(f'{c} NULLS FIRST' for c in content)}) AS r
      FROM (SELECT {columns}, snapshot_date FROM ({raw})) WHERE t_id IS NOT NULL) WHERE r = 1"""


@case(f"""SELECT * REPLACE (coalesce(author, '<none>') AS author) FROM (
  {_newest_sql(_N_COLUMNS, _window(RAW_N_SQL, ANCHOR))} UNION ALL {_newest_sql(_K_COLUMNS, _window(RAW_K_SQL, ANCHOR))})""")
def build_title_info(spark, sf):
    info = _flat(C.title_info(raw_n(spark, sf), raw_k(spark, sf), ANCHOR))
    return info.withColumn("author", F.coalesce("author", F.lit("<none>")))


_FINISHED_DAY = date(2024, 3, 5)  # 50 days after a day in the middle of the table


@case(_newest_sql(_F_COLUMNS, f"SELECT * FROM ({RAW_F_SQL}) WHERE snapshot_date = DATE '{_FINISHED_DAY}' - 50", running=False))
def build_finished_info(spark, sf):
    return _flat(C.finished_info(finished_n(spark, sf), _FINISHED_DAY))


@case(f"""SELECT 'N' || t_IDs AS t_id, array_to_string(t_comments, '|') AS best_comments FROM ({_window(RAW_N_SQL, ANCHOR)})
  UNION ALL SELECT 'K' || id, array_to_string(best_comments, '|') FROM ({_window(RAW_K_SQL, ANCHOR)})""")
def build_comments(spark, sf):
    return _flat(C.comments(raw_n(spark, sf), raw_k(spark, sf), ANCHOR))
