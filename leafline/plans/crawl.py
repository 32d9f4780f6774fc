"""Records of a day from its stored pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.functions import html as H
from leafline.functions.fields import NO_AGE_RATING, default_value, strip_ws
from leafline.functions.urls import fill_template, query_value, tail_id
from leafline.operators import pages as P
from leafline.operators.lookup import weekday_lookup
from leafline.schemas import K_CSV_COMPLETED, K_CSV_WEEKDAY, N_FINISHED
from leafline.sources.sinks import CSV_LISTS

# The parameters of a comment page's address.
COMMENT_PAGE = "{host}/comment/comment.nhn?titleId=%s&no=%s#"


def detail_records(
    pages: DataFrame,
    patterns: Mapping[str, H.Pattern] = H.DETAIL_FIELDS,
    id_param: str = "titleId",
    comment_pattern: str | H.Element | None = None,
) -> DataFrame:
    """One record per detail page, in the columns of the site-N table; with
    `comment_pattern` the page's own comments too."""
    extra = {} if comment_pattern is None else {"t_comments": P.page_comments(F.col("html"), comment_pattern)}
    read = P.page_fields(pages, patterns, extra)
    fixed = {"t_IDs": query_value(F.col("url"), id_param), "t_urls": F.col("url")}
    if "t_auth" in patterns:
        fixed["t_auth"] = strip_ws(F.col("t_auth"))
    if "t_age" in patterns:
        fixed["t_age"] = default_value(F.col("t_age"), NO_AGE_RATING)
    return read.withColumns(fixed).drop("url")


def newest_episode_links(pages: DataFrame, within: tuple[str | H.Element, ...] = H.NEWEST_EPISODE[:1]) -> DataFrame:
    """(page_id, url, href) of the first episode link of each page: null without one."""
    return pages.select("page_id", "url", H.first_link(F.col("html"), within).alias("href"))


def comment_page_links(
    pages: DataFrame, host: str, id_param: str = "titleId", within: tuple[str | H.Element, ...] = H.NEWEST_EPISODE[:1], no_param: str = "no"
) -> DataFrame:
    """(page_id, link) of the newest episode's comment page; null where the page's
    id or the episode's number is not known."""
    newest = newest_episode_links(pages, within)
    link = fill_template(
        COMMENT_PAGE.format(host=host.rstrip("/")), query_value(F.col("url"), id_param), query_value(F.col("href"), no_param)
    )
    return newest.select("page_id", link.alias("link"))


def finished_records(
    listing: DataFrame, pages: DataFrame, host: str, patterns: Mapping[str, H.Pattern] = H.DETAIL_FIELDS,
    min_rating: float = P.MIN_RATING, id_param: str = "titleId",
) -> DataFrame:
    """The day's records of finished titles, 8 columns: the detail pages (url,
    html) that links rated at least `min_rating` of the listing pages lead to."""
    wanted = P.rated_links(listing, host, min_rating).select(F.col("link").alias("url")).distinct()
    return detail_records(pages.join(wanted, "url", "left_semi"), patterns, id_param).select(*[f.name for f in N_FINISHED])


def _list_of(html, pattern: str | H.Element):
    return P.page_attr_list(html, pattern) if isinstance(pattern, H.AttributePattern) else P.page_comments(html, pattern)


def k_records(
    pages: DataFrame, patterns: Mapping[str, H.Pattern], lists: Mapping[str, str | H.Element], weekday: bool = True
) -> DataFrame:
    """Site K's rows from stored detail pages, in the 15 columns of a weekday
    crawl or the 14 of a completed one. `serial` is the number at the end of the
    page's address; `lists` are the patterns of list columns, whose matches all
    count; a column without a pattern is null, a list without one empty."""
    schema = K_CSV_WEEKDAY if weekday else K_CSV_COMPLETED
    html, address = F.col("html"), F.regexp_extract("url", r"^[^?#]*", 0)
    read = {"serial": tail_id(F.regexp_replace(address, "/$", "")).cast("string"), "url": F.col("url")}
    for name in schema.fieldNames():
        if name in read:
            continue
        if name in CSV_LISTS:
            read[name] = _list_of(html, lists[name]) if name in lists else F.array().cast("array<string>")
        else:
            read[name] = H.field_text(html, patterns[name]) if name in patterns else F.lit(None).cast("string")
    return pages.select(*[read[n].alias(n) for n in schema.fieldNames()])


def daily_records(
    pages: DataFrame,
    anchors: DataFrame,
    patterns: Mapping[str, H.Pattern] = H.DETAIL_FIELDS,
    comment_pattern: str | H.Element = H.COMMENT,
    comment_pages: DataFrame | None = None,
    id_param: str = "titleId",
) -> DataFrame:
    """The day's records with weekdays and comments. Comments come from the
    pages themselves, or from `comment_pages` (page_id, html) stored apart."""
    own = comment_pattern if comment_pages is None else None
    records = detail_records(pages, patterns, id_param, own)
    if comment_pages is not None:
        found = comment_pages.select("page_id", P.page_comments(F.col("html"), comment_pattern).alias("t_comments"))
        records = records.join(found, "page_id", "left")
    return weekday_lookup(records, anchors, "t_names").withColumnRenamed("weekdays", "t_weekdays")
