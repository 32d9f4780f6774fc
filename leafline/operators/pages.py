"""Stored pages (page_id, url, html) to links, records and lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions import html as H
from leafline.functions.fields import at_least, flatten_newlines
from leafline.functions.urls import absolute_link

MIN_RATING = 9.9


def page_links(
    pages: DataFrame, host: str, within: tuple[str, int] | None = None, keys: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """(keys, pos, href, link) of every link, or of those in the i-th section:
    `within` is (section pattern, i)."""
    source = F.col("html") if within is None else H.section(F.col("html"), *within)
    found = pages.select(*keys, F.posexplode(H.links_in(source)).alias("pos", "href"))
    return found.withColumn("link", absolute_link(host, F.col("href")))


def page_anchors(pages: DataFrame, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(keys, pos, href, text) of every link."""
    tag = pages.select(*keys, F.posexplode(H.all_matches(F.col("html"), H.LINK_TEXT, 0)).alias("pos", "tag"))
    return tag.select(
        *keys,
        "pos",
        H.attr_value(F.regexp_extract("tag", H.LINK_TEXT, 1)).alias("href"),
        H.inner_text(F.regexp_extract("tag", H.LINK_TEXT, 2)).alias("text"),
    )


def rated_links(pages: DataFrame, host: str, min_rating: float = MIN_RATING) -> DataFrame:
    """(page_id, pos, href, rating, link) of list items rated at least `min_rating`;
    an item without a readable rating or a link does not count."""
    items = pages.select("page_id", F.posexplode(H.all_matches(F.col("html"), H.LIST_ITEM)).alias("pos", "item"))
    read = items.select(
        "page_id",
        "pos",
        H.first_link(F.col("item")).alias("href"),
        H.first_match(F.col("item"), H.RATING).alias("rating"),
    )
    kept = read.where(at_least(F.col("rating"), min_rating) & F.col("href").isNotNull())
    return kept.withColumn("link", absolute_link(host, F.col("href")))


def page_fields(pages: DataFrame, patterns: Mapping[str, H.Pattern], extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One record per page: the first match of every field's pattern, as text."""
    read = {n: H.field_text(F.col("html"), p) for n, p in patterns.items()}
    return pages.select("page_id", "url", *[c.alias(n) for n, c in {**read, **(extra or {})}.items()])


def page_comments(html: Column, pattern: str | H.Element = H.COMMENT) -> Column:
    """array<string>: the comments on a page, each on one line: the text of every
    such element, whatever is nested in it, or of the pattern's group."""
    found = H.elements(html, pattern) if isinstance(pattern, H.Element) else H.all_matches(html, pattern)
    return flatten_newlines(F.transform(found, H.inner_text))


def page_attr_list(html: Column, pattern: str) -> Column:
    """array<string>: one attribute or badge text of every matching tag."""
    return H.attr_values(html, pattern) if isinstance(pattern, H.AttributePattern) else H.all_matches(html, pattern)
