"""Field, link and date functions."""

from pyspark.sql import functions as F

from leafline.functions import dates as D
from leafline.functions import fields as X
from leafline.functions import html as H
from leafline.functions import urls as U
from leafline.operators import records as R
from suite.frames import DOCUMENTS_SQL, document_comments
from suite.registry import case, table

HOST = "https://titles.example"


@case("""SELECT o_orderkey, array_to_string(string_split(replace(o_orderpriority, '-', '/'), '/'), '|') AS genre,
  len(string_split(replace(o_orderpriority, '-', '/'), '/'))::BIGINT AS n FROM orders""")
def split_genre_slash(spark, sf):
    parts = X.split_slash(F.replace("o_orderpriority", F.lit("-"), F.lit("/")))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(parts, "|").alias("genre"), F.size(parts).cast("long").alias("n")
    )


@case("""SELECT p_partkey, array_to_string(string_split(p_type || ', ' || p_brand, ', '), '|') AS genre,
  len(string_split(p_type || ', ' || p_brand, ', '))::BIGINT AS n FROM part""")
def split_genre_comma(spark, sf):
    parts = X.split_comma(F.concat("p_type", F.lit(", "), "p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(parts, "|").alias("genre"), F.size(parts).cast("long").alias("n")
    )


@case("""SELECT s_suppkey, array_to_string(string_split(s_name || ' / ' || s_nationkey, ' / '), '|') AS authors FROM supplier""")
def split_author(spark, sf):
    parts = X.split_authors(F.concat("s_name", F.lit(" / "), F.col("s_nationkey").cast("string")))
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(parts, "|").alias("authors"))


@case("""SELECT l_orderkey, l_linenumber, CASE WHEN o_orderstatus = l_linestatus THEN o_orderstatus
  ELSE coalesce(l_linestatus || '/' || nullif(o_orderstatus, 'P'), '<none>') END AS author
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def author_merge(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.nullif("o_orderstatus", F.lit("P")).alias("drawn_by")
    )
    merged = X.merged_author(F.col("l_linestatus"), F.col("drawn_by"))
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", F.coalesce(merged, F.lit("<none>")).alias("author")
    )


@case(f"""SELECT t_id, comment_pos, pos - 1 AS line_pos, line FROM (
  SELECT t_id, comment_pos, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
  FROM (SELECT t_id, comment_pos, string_split(comment, chr(10)) AS lines FROM ({DOCUMENTS_SQL})))""")
def explode_comments(spark, sf):
    lines = document_comments(spark, sf).select(
        "t_id", F.col("comment_pos").alias("doc"), F.split("comment", "\n").alias("best_comments")
    )
    rows = R.explode_comments(lines, keys=("t_id", "doc"))
    return rows.select(
        "t_id", F.col("doc").alias("comment_pos"), F.col("comment_pos").cast("long").alias("line_pos"),
        F.col("comment").alias("line"),
    )


@case("SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '<none>') AS page, "
      "coalesce(nullif(regexp_extract(url, '[?][^=&#]*=([^&#]*)', 1), ''), '<none>') AS first FROM pages")
def url_query_value(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.coalesce(U.query_value(F.col("url"), "page"), F.lit("<none>")).alias("page"),
        F.coalesce(U.first_query_value(F.col("url")), F.lit("<none>")).alias("first"),
    )


@case(f"""SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<a[^>]*href="([^"]+)"', 1),
  lambda h: CASE WHEN h LIKE '/%' THEN '{HOST}' || h ELSE h END)) AS link FROM pages""")
def absolute_links(spark, sf):
    hrefs = table(spark, sf, "pages").select("page_id", F.explode(H.links_in(F.col("html"))).alias("href"))
    return hrefs.select("page_id", U.absolute_link(HOST, F.col("href")).alias("link"))


@case("""SELECT page_id, coalesce(TRY_CAST(string_split(url, '/')[-1] AS BIGINT)::VARCHAR, '<none>') AS serial FROM pages""")
def url_tail_id(spark, sf):
    serial = U.tail_id(F.col("url")).cast("string")
    return table(spark, sf, "pages").select("page_id", F.coalesce(serial, F.lit("<none>")).alias("serial"))


@case("""SELECT conv_id, turn, 'https://titles.example/comment?titleId=' || conv_id || '&no=' || turn || '#' AS link
  FROM conversations""")
def url_template(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", U.fill_template(HOST + "/comment?titleId=%d&no=%d#", F.col("conv_id"), F.col("turn")).alias("link")
    )


@case("""SELECT page_id, coalesce(nullif(string_split(string_split(url, '&')[2], '=')[2], ''), '<none>') AS code FROM pages""")
def link_param(spark, sf):
    code = U.link_param(F.col("url"), 1)
    return table(spark, sf, "pages").select("page_id", F.coalesce(F.nullif(code, F.lit("")), F.lit("<none>")).alias("code"))


@case("SELECT doc_id, replace(text, chr(10), ' ') AS flat FROM documents")
def flatten_newlines(spark, sf):
    flat = X.flatten_newlines(F.array("text"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(flat, "|").alias("flat"))


@case(r"SELECT doc_id, regexp_replace(regexp_replace(chr(9) || text || chr(10), '^\s+', ''), '\s+$', '') AS stripped FROM documents")
def strip_ws(spark, sf):
    padded = F.concat(F.lit("\t"), "text", F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", X.strip_ws(padded).alias("stripped"))


@case("""SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''), '연령가 없음') AS age FROM pages""")
def default_value(spark, sf):
    ref = F.regexp_extract("url", r"[?&]ref=([^&#]*)", 1)
    return table(spark, sf, "pages").select("page_id", X.default_value(ref, X.NO_AGE_RATING).alias("age"))


@case("SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y%m%d') AS day FROM events")
def kst_day_key(spark, sf):
    return table(spark, sf, "events").select("event_id", D.day_key(F.col("ts")).alias("day"))


@case("SELECT event_id, lower(strftime(ts + INTERVAL 9 HOUR, '%a')) AS weekday FROM events")
def kst_weekday(spark, sf):
    return table(spark, sf, "events").select("event_id", D.weekday_code(F.col("ts")).alias("weekday"))


@case("""SELECT page_id, coalesce(nullif(regexp_extract(html, '<a[^>]*href="([^"]+)"', 1), ''), '<none>') AS href FROM pages""")
def first_link(spark, sf):
    href = H.first_link(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.coalesce(href, F.lit("<none>")).alias("href"))
