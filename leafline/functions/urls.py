"""Parts of links and links made of parts. Nothing here raises on odd input:
what is not there comes out as null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def query_value(url: Column, name: str) -> Column:
    """Value of one query parameter, of relative links too."""
    return _present(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1))


def first_query_value(url: Column) -> Column:
    return _present(F.regexp_extract(url, r"\?[^=&#]*=([^&#]*)", 1))


def link_param(href: Column, position: int) -> Column:
    """Value of the parameter at `position` (0-based) in a link."""
    return F.get(F.split(F.get(F.split(href, "&"), F.lit(position)), "="), F.lit(1))


def absolute_link(host: str, href: Column) -> Column:
    """Prefix relative links with the host; absolute ones stay."""
    return F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(host.rstrip("/")), href)).otherwise(href)


def tail_id(url: Column) -> Column:
    """Number at the end of a URL path."""
    return F.try_element_at(F.split(url, "/"), F.lit(-1)).try_cast("bigint")


def fill_template(template: str, *values: Column) -> Column:
    """A printf-style template filled per row; absent if any part is."""
    known = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    return F.when(known, F.format_string(template, *values))
