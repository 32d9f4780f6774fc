"""Ranks, best-of-group and favourite-genre boost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BOOST = 1.3
DEFAULT_GENRE = "스토리"  # fixed value: the genre of a reader who names none


def ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], first: int, last: int, name: str = "rank"
) -> DataFrame:
    """Rows ranked `first`..`last` within each group. Spark cuts every task's
    rows to `last` per group before the shuffle, so one hot group is as
    cheap as many small ones."""
    if not group:
        df = df.orderBy(*order).limit(last)  # one group: a distributed top-k, then number its rows
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(
        (F.col(name) <= last) & (F.col(name) >= first)
    )


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in `order` (newest snapshot first, then
    whatever makes the choice unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return ranked(df, keys, order, 1, 1, "_rank").drop("_rank")


def offset_limit(df: DataFrame, order: Sequence[Column | str], skip: int, take: int) -> DataFrame:
    """Rows `skip`+1 .. `skip`+`take` of the whole table in `order`."""
    return df.orderBy(*order).limit(skip + take).offset(skip)


def top(df: DataFrame, order: Sequence[Column | str], take: int) -> DataFrame:
    return df.orderBy(*order).limit(take)


def dedup_keep_best(df: DataFrame, key: Sequence[str], rank: str = "rank") -> DataFrame:
    """Distinct `key` with its best (lowest) rank."""
    return df.groupBy(*key).agg(F.min(rank).alias(rank))


def max_score_per_title(hits: DataFrame, by: Sequence[str] = ("t_id",)) -> DataFrame:
    return hits.groupBy(*by).agg(F.max("score").alias("score"))


def favourites(genres: Column) -> Column:
    """The reader's genres; the default one where none is named."""
    named = F.filter(genres, lambda g: g.isNotNull())
    return F.when(F.size(named) > 0, named).otherwise(F.array(F.lit(DEFAULT_GENRE)))


def genre_boost(score: Column, genre: Column, favs: Column, factor: float = BOOST) -> Column:
    """A title with any favourite genre counts `factor` times."""
    return F.when(F.arrays_overlap(genre, favs), score * factor).otherwise(score)
