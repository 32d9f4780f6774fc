"""Day keys and weekday codes in the sites' own time zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SITE_ZONE = "Asia/Seoul"
DASHED = "%Y-%m-%d"
COMPACT = "%Y%m%d"


def site_time(utc: Column) -> Column:
    """A zoneless UTC timestamp in the sites' zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(SITE_ZONE), utc)


def day_key(utc: Column) -> Column:
    return F.date_format(site_time(utc), "yyyyMMdd")


def weekday_code(utc: Column) -> Column:
    """`mon` .. `sun`"""
    return F.lower(F.date_format(site_time(utc), "E"))


def lookback_days(anchor: date, back: int) -> list[date]:
    """The anchor and the `back` days before it, newest first."""
    return [anchor - timedelta(days=i) for i in range(back + 1)]
