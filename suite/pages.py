"""Links, fields and lists of stored pages."""

from pyspark.sql import functions as F

from leafline.functions import html as H
from leafline.operators import lookup as L
from leafline.operators import pages as P
from leafline.plans import crawl as C
from leafline.session import scratch_path
from leafline.sources import sinks as K
from suite.registry import case, table

HOST = "https://titles.example"
PARAGRAPH = r"(?s)<p>(.*?)</p>"
FIELDS = {
    "title": r"(?s)<title>(.*?)</title>",
    "heading": r"(?s)<h1[^>]*>(.*?)</h1>",
    "lang": r'<html[^>]*lang="([^"]*)"',
    "summary": PARAGRAPH,
}


def _text_sql(fragment: str) -> str:
    return _resolve_sql(f"regexp_replace({fragment}, '<[^>]*>', '', 'g')")


def _resolve_sql(text: str) -> str:
    for entity, char in H.ENTITIES.items():
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


def _field_sql(pattern: str) -> str:
    return f"coalesce({_text_sql(f'''nullif(regexp_extract(html, '{pattern}', 1), '')''')}, '<none>')"


_HREF = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
_LINK_SQL = r"(?i)<a\b[^>]*?\bhref\s*=\s*" + _HREF.replace("'", "''")


def _attr_sql(value: str) -> str:
    return _resolve_sql(f"""regexp_replace({value}, '^["'']|["'']$', '', 'g')""")


@case(f"""SELECT page_id, pos, href, CASE WHEN href LIKE '/%' THEN '{HOST}' || href ELSE href END AS link FROM (
  SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos
  FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '{_LINK_SQL}', 1), lambda v: {_attr_sql('v')}),
    lambda v: v <> '') AS h FROM pages))""")
def page_links(spark, sf):
    links = P.page_links(table(spark, sf, "pages"), HOST)
    return links.select("page_id", F.col("pos").cast("long").alias("pos"), "href", "link")


def _listing(spark, sf: str):
    """A listing page per part: the part, and a neighbour without a rating."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.format_string(
            '<ul>\n<li><dl><dt><a href="/list?titleId=%d">%s</a></dt><dd><strong>%.1f</strong></dd></dl></li>\n'
            '<li><dl><dt><a href="/list?titleId=x%d">new</a></dt><dd><strong>none</strong></dd></dl></li></ul>',
            "p_partkey", "p_name", F.col("p_size") / 5, "p_partkey",
        ).alias("html"),
    )


@case(f"""SELECT p_partkey AS page_id, 0::BIGINT AS pos, '{HOST}/list?titleId=' || p_partkey AS link,
  printf('%.1f', p_size / 5.0) AS rating FROM part WHERE round(p_size / 5.0, 1) >= 9.9""")
def page_links_filtered(spark, sf):
    return P.rated_links(_listing(spark, sf), HOST).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "link", "rating"
    )


@case(f"SELECT page_id, url, {', '.join(f'{_field_sql(p)} AS {n}' for n, p in FIELDS.items())} FROM pages")
def page_fields(spark, sf):
    read = P.page_fields(table(spark, sf, "pages"), FIELDS)
    return read.select("page_id", "url", *[F.coalesce(n, F.lit("<none>")).alias(n) for n in FIELDS])


_COMMENTS_SQL = f"""list_transform(regexp_extract_all(html, '{PARAGRAPH}', 1), lambda c: replace({_text_sql('c')}, chr(10), ' '))"""


@case(f"SELECT page_id, len(c)::BIGINT AS n, array_to_string(c, '|') AS comments FROM (SELECT page_id, {_COMMENTS_SQL} AS c FROM pages)")
def page_comments(spark, sf):
    found = table(spark, sf, "pages").select("page_id", P.page_comments(F.col("html"), PARAGRAPH).alias("c"))
    return found.select("page_id", F.size("c").cast("long").alias("n"), F.array_join("c", "|").alias("comments"))


@case("""SELECT page_id, array_to_string(regexp_extract_all(html, '<a href="/([^"]*)"', 1), '|') AS badges FROM pages""")
def page_attr_list(spark, sf):
    badges = P.page_attr_list(F.col("html"), '<a href="/([^"]*)"')
    return table(spark, sf, "pages").select("page_id", F.array_join(badges, "|").alias("badges"))


@case("""SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '<a\\b[^>]*?\\bhref="([^"]*)"', 1),
  lambda v: replace(v, '&amp;', '&')), lambda v: v <> ''), '|') AS hrefs FROM pages""")
def page_attribute_values(spark, sf):
    hrefs = P.page_attr_list(F.col("html"), H.attribute("a", "href"))
    return table(spark, sf, "pages").select("page_id", F.array_join(hrefs, "|").alias("hrefs"))


@case("""SELECT conv_id, array_to_string(list(replace(body, chr(10), ' ') ORDER BY turn, place), '|') AS comments FROM (
  SELECT conv_id, turn, unnest([0, 1]) AS place, unnest(['1' || text || '2' || role || '3' || turn || '4', text || '2' || role || '3' || turn]) AS body
  FROM conversations) GROUP BY conv_id""")
def nested_comments(spark, sf):
    """A page per conversation; each turn is a comment with three levels of tags
    of its own name, the outermost of which is a comment again."""
    escaped = F.col("text")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    turn = F.format_string(
        "<div id='c%d' class=\"x u_cbox_contents\">1<DIV class='u_cbox_contents'>%s<div>2<i>%s</i><div>3</div></div>%d</DIV>4<br></div><p>-</p>",
        "turn", escaped, "role", "turn",
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", turn.alias("html"))
    html = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "html"))), lambda t: t.html), "\n")
    pages = turns.groupBy("conv_id").agg(html.alias("html"))
    return pages.select("conv_id", F.array_join(P.page_comments(F.col("html")), "|").alias("comments"))


_CODES = "element_at(array('mon','tue','wed','thu','fri','sat','sun'), cast(pmod({n}, 7) + 1 as int))"
_CODES_SQL = "['mon','tue','wed','thu','fri','sat','sun'][{n} % 7 + 1]"


def _by_text_sql(anchors: str) -> str:
    return f"""SELECT text, array_to_string(list(code ORDER BY pos), '|') AS weekdays
      FROM (SELECT text, code, min(pos) AS pos FROM ({anchors}) GROUP BY ALL) GROUP BY text"""


@case(f"""SELECT t.p_partkey, coalesce(w.weekdays, '') AS weekdays
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'unlisted' ELSE p_name END AS name FROM part) t
  LEFT JOIN ({_by_text_sql(f'''SELECT p_name AS text, {_CODES_SQL.format(n='p_size')} AS code, p_partkey AS pos
    FROM part WHERE p_partkey % 5 <> 0''')}) w ON t.name = w.text""")
def weekday_lookup(spark, sf):
    part = table(spark, sf, "part")
    key = F.when(F.col("p_partkey") % 5 == 0, F.lit("day")).otherwise(F.lit("weekday"))
    anchors = part.select(
        F.col("p_name").alias("text"),
        F.format_string("/list?titleId=%d&%s=%s", "p_partkey", key, F.expr(_CODES.format(n="p_size"))).alias("href"),
        F.col("p_partkey").alias("pos"),
    )
    name = F.when(F.col("p_partkey") % 11 == 0, F.lit("unlisted")).otherwise(F.col("p_name"))
    found = L.weekday_lookup(part.select("p_partkey", name.alias("name")), anchors, "name")
    return found.select("p_partkey", F.array_join("weekdays", "|").alias("weekdays"))


_NAME = r"(?s)<li><a[^>]*>(.*?)</a>"
_RECORD_FIELDS = {"t_names": _NAME, "t_auth": FIELDS["heading"], "t_age": r'<b class="age">(.*?)</b>', "t_sum": FIELDS["summary"]}
_TEXTS_SQL = r"""SELECT page_id, unnest(t) AS text, page_id * 1000000 + generate_subscripts(t, 1) - 1 AS pos,
  ['mon','tue','wed','thu','fri','sat','sun'][page_id % 7 + 1] AS code
  FROM (SELECT page_id, list_transform(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)[^>]*>(.*?)</a\s*>', 1), lambda c: {c}) AS t FROM pages)
  """.replace("{c}", _text_sql("c"))


@case(f"""SELECT page_id, t_names, t_auth, t_age, t_sum, t_urls, n_comments, coalesce(weekdays, '') AS t_weekdays FROM (
  SELECT page_id, {_field_sql(_NAME)} AS t_names,
    coalesce(trim({_text_sql(f'''nullif(regexp_extract(html, '{FIELDS['heading']}', 1), '')''')}), '<none>') AS t_auth,
    '연령가 없음' AS t_age, {_field_sql(PARAGRAPH)} AS t_sum, url AS t_urls,
    len(regexp_extract_all(html, '{PARAGRAPH}', 1))::BIGINT AS n_comments FROM pages) p
  LEFT JOIN ({_by_text_sql(_TEXTS_SQL)}) w ON p.t_names = w.text""")
def daily_records(spark, sf):
    pages = table(spark, sf, "pages")
    # the pages' own links as the listing, each with its page's weekday
    anchors = P.page_anchors(pages).select(
        "text",
        F.format_string("/list?titleId=%d&weekday=%s", "page_id", F.expr(_CODES.format(n="page_id"))).alias("href"),
        (F.col("page_id") * 1000000 + F.col("pos")).alias("pos"),
    )
    records = C.daily_records(pages, anchors, _RECORD_FIELDS, PARAGRAPH, id_param="page")
    return records.select(
        "page_id", "t_age", "t_urls", F.size("t_comments").cast("long").alias("n_comments"),
        *[F.coalesce(c, F.lit("<none>")).alias(c) for c in ("t_names", "t_auth", "t_sum")],
        F.array_join("t_weekdays", "|").alias("t_weekdays"),
    )


_PAGE_NO = "regexp_extract(url, '[?&]page=([^&#]*)', 1)"
_FIRST_LINK = f"""nullif({_attr_sql(f"regexp_extract(regexp_extract(html, '(?s)<p>(.*?)</p>', 1), '{_LINK_SQL}', 1)")}, '')"""


@case(f"SELECT page_id, url, coalesce({_FIRST_LINK}, '<none>') AS href FROM pages")
def newest_episode_link(spark, sf):
    found = C.newest_episode_links(table(spark, sf, "pages"), (PARAGRAPH,))
    return found.withColumn("href", F.coalesce("href", F.lit("<none>")))


_FINISHED_FIELDS = {"t_names": FIELDS["heading"], "t_auth": FIELDS["title"], "t_genre": FIELDS["lang"], "t_sum": PARAGRAPH}


@case(f"""SELECT coalesce(nullif({_PAGE_NO}, ''), '<none>') AS t_IDs, url AS t_urls, {_field_sql(FIELDS['heading'])} AS t_names,
    coalesce(trim({_text_sql(f"nullif(regexp_extract(html, '{FIELDS['title']}', 1), '')")}), '<none>') AS t_auth,
    {_field_sql(FIELDS['lang'])} AS t_genre, {_field_sql(PARAGRAPH)} AS t_sum FROM pages WHERE page_id % 5 <> 0""")
def finished_records(spark, sf):
    """Listing pages made of the pages' own addresses, every fifth rated too low."""
    pages = table(spark, sf, "pages")
    rating = F.when(F.col("page_id") % 5 == 0, "9.8").otherwise("9.95")
    item = F.format_string("<ul><li><a href='%s'>t</a><strong>%s</strong></li></ul>", F.replace("url", F.lit("&"), F.lit("&amp;")), rating)
    patterns = {**_FINISHED_FIELDS, "t_age": r'<b class="age">(.*?)</b>', "t_thumbs": r'<i class="thumb">(.*?)</i>'}
    found = C.finished_records(pages.select("page_id", item.alias("html")), pages, HOST, patterns, id_param="page")
    return found.select(*[F.coalesce(c, F.lit("<none>")).alias(c) for c in ("t_IDs", "t_urls", "t_names", "t_auth", "t_genre", "t_sum")])


@case(f"""SELECT coalesce(TRY_CAST(regexp_extract(regexp_extract(url, '^[^?#]*'), '([0-9]+)/?$', 1) AS BIGINT)::VARCHAR, '<none>') AS id, url,
    {_field_sql(FIELDS['title'])} AS title, {_field_sql(FIELDS['heading'])} AS story_line,
    array_to_string({_COMMENTS_SQL}, '|') AS best_comments, 0::BIGINT AS n_words FROM pages""")
def k_page_records(spark, sf):
    """Rows of a weekday crawl, written as CSV and read back as snapshot rows."""
    rows = C.k_records(
        table(spark, sf, "pages"), {"title": FIELDS["title"], "story_line": FIELDS["heading"]}, {"best_comments": PARAGRAPH}
    )
    path = scratch_path(spark, "crawl")
    K.write_csv(rows, path)
    return K.read_weekday_csv(spark, path).select(
        F.coalesce("id", F.lit("<none>")).alias("id"), "url", F.coalesce("title", F.lit("<none>")).alias("title"),
        F.coalesce("story_line", F.lit("<none>")).alias("story_line"), F.array_join("best_comments", "|").alias("best_comments"),
        F.size("key_words").cast("long").alias("n_words"),
    )
