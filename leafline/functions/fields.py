"""Clean-up of single text and list fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_AGE_RATING = "연령가 없음"  # fixed value: age rating of a title that shows none
K_PREFIX, N_PREFIX = "K", "N"
K_SITE, N_SITE = 0, 1


def title_key(prefix: str, raw_id: Column) -> Column:
    """Global title id; a missing id stays missing."""
    return F.concat(F.lit(prefix), raw_id)


def split_slash(genre: Column) -> Column:
    return F.split(genre, "/")


def split_comma(genre: Column) -> Column:
    return F.split(genre, ", ")


def split_authors(author: Column) -> Column:
    return F.split(author, " / ")


def merged_author(writer: Column, illustrator: Column) -> Column:
    """One name if the same person writes and draws, else writer/illustrator;
    unknown if either is unknown."""
    return F.when(illustrator == writer, illustrator).otherwise(F.concat(writer, F.lit("/"), illustrator))


def strip_ws(text: Column) -> Column:
    """Drop blanks, tabs and line ends on both sides."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")


def default_value(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def flatten_newlines(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.replace(t, F.lit("\n"), F.lit(" ")))


def has_items(values: Column) -> Column:
    return F.size(values) > 0


def at_least(text: Column, threshold: float) -> Column:
    """Text that reads as a number of at least `threshold`; other text does not pass."""
    return F.coalesce(text.try_cast("double") >= threshold, F.lit(False))
