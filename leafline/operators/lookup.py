"""Weekdays of a title from the listing's links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.functions.urls import link_param


def weekday_links(anchors: DataFrame, text: str = "text", href: str = "href") -> DataFrame:
    """(text, code, pos) of every link that names a weekday; `pos` is its place in
    the listing."""
    marked = anchors.where(F.contains(F.col(href), F.lit("weekday")))
    return marked.select(F.col(text).alias("text"), link_param(F.col(href), 1).alias("code"), "pos")


def weekday_lookup(titles: DataFrame, anchors: DataFrame, name: str) -> DataFrame:
    """Titles with `weekdays`: the codes of all links whose text is the title's
    name, each once, in listing order; an empty array if there is none.

    Links are folded to one row per text before the join. A name that stands on
    many links or many titles therefore never multiplies rows, and the arrays
    are no longer than the set of codes."""
    once = weekday_links(anchors).where(F.col("code").isNotNull()).groupBy("text", "code").agg(F.min("pos").alias("pos"))
    by_text = once.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("__found"))
    by_text = by_text.withColumnRenamed("text", "__text")
    joined = titles.join(by_text, titles[name] == by_text["__text"], "left")
    codes = F.coalesce(F.transform("__found", lambda x: x.code), F.array().cast("array<string>"))
    return joined.withColumn("weekdays", codes).drop("__found", "__text")
