"""The newest row per key of the last days, kept up day by day.

Each day leaves one partial, its newest row per key, which never changes unless
the day is run again. The result of any anchor day is the merge of the partials in its
window: a day's rows are read once, when they come, and drop out of the window by
their day alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.operators.ranking import latest_per_key
from leafline.sources.reruns import MARKERS, complete_partitions, read_complete, replace_partition
from leafline.sources.snapshots import BACK

DAY = "state_day"


def add_day(df: DataFrame, path: str, day: date, key: str, order: Sequence[Column | str]) -> int:
    """Reduce a day's rows to its partial and store it in place of an earlier run's;
    the number of its keys. Rows without a key are left out."""
    return replace_partition(latest_per_key(df.where(F.col(key).isNotNull()), key, order), path, {DAY: day})


def newest(spark: SparkSession, path: str, anchor: date, key: str, order: Sequence[Column | str], back: int = BACK) -> DataFrame:
    """The newest row per key of the anchor day and the `back` days before it: the
    latest day's, and within it the first in `order`. Days that are missing or
    not complete have no rows."""
    first = anchor - timedelta(days=back)
    rows = read_complete(spark, path)
    if rows is None:
        raise ValueError(f"no complete day under {path}")
    window = rows.where(F.col(DAY).between(F.lit(first), F.lit(anchor)))
    return latest_per_key(window, key, [F.col(DAY).desc(), *order]).drop(DAY)


def expire(spark: SparkSession, path: str, anchor: date, back: int = BACK) -> list[date]:
    """Delete the partials of days before the anchor's window; the days deleted."""
    done = complete_partitions(spark, path)
    old = [] if done is None else [r[0] for r in done.where(F.col(DAY) < F.lit(anchor - timedelta(days=back))).select(DAY).collect()]
    for day in old:
        for folder in (f"{path}/{MARKERS}/{DAY}={day}", f"{path}/{DAY}={day}"):
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return sorted(old)
