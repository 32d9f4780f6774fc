"""Daily snapshots: one JSON file (or folder of part files) per day."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafline.functions.dates import COMPACT, DASHED, lookback_days
from leafline import session
from leafline.schemas import CORRUPT, with_corrupt

BACK = 5
FINISHED_OFFSET = 50
# how a day's key looks in a path, and how to parse it
_PATTERNS = {DASHED: (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"), COMPACT: (r"\d{8}", "yyyyMMdd")}


def date_of_path(style: str) -> Column:
    digits, parse = _PATTERNS[style]
    found = F.regexp_extract(F.col("_metadata.file_path"), rf"[/=]({digits})\.json(?:/|$)", 1)
    return F.to_date(F.nullif(found, F.lit("")), parse)


def load_days(load: Callable[[list[str]], DataFrame], base: str, days: list[date], style: str) -> DataFrame:
    """`load` for the files of the given days, the first of which must exist."""
    anchor, *others = [d.strftime(style) for d in days]
    paths = [f"{base}{anchor}.json"]
    if others:
        paths.append(f"{base}{{{','.join(others)}}}.json")
    try:
        return load(paths)
    except AnalysisException as e:
        if len(paths) == 1 or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return load(paths[:1])  # none of the optional days; raises if the anchor is missing


def read_days(
    spark: SparkSession, base: str, schema: StructType, days: list[date], style: str, keep_corrupt: bool = False
) -> DataFrame:
    """Scan `<base><day>.json` for the given days, the first of which must exist;
    the others may be missing. One scan over one list of files, with the day as
    `snapshot_date`. Fields are matched by name and broken lines never stop the
    scan: they keep their text in the corrupt-record column if asked for, and
    come out as rows of nulls otherwise."""
    reader = spark.read.schema(with_corrupt(schema) if keep_corrupt else schema).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return load_days(reader.json, base, days, style).withColumn("snapshot_date", date_of_path(style))


def scan_lookback(
    spark: SparkSession, base: str, schema: StructType, anchor: date, style: str, back: int = BACK,
    keep_corrupt: bool = False,
) -> DataFrame:
    return read_days(spark, base, schema, lookback_days(anchor, back), style, keep_corrupt)


def scan_offset(
    spark: SparkSession, base: str, schema: StructType, anchor: date, style: str, offset: int = FINISHED_OFFSET,
    keep_corrupt: bool = False,
) -> DataFrame:
    """The one snapshot `offset` days before the anchor."""
    return read_days(spark, base, schema, [anchor - timedelta(days=offset)], style, keep_corrupt)


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A stored table; see `session.spread` for `spread`."""
    df = spark.read.parquet(path)
    return session.spread(df) if spread else df


def lookback(df: DataFrame, anchor: date, back: int = BACK, on: str = "snapshot_date") -> DataFrame:
    """Rows of the anchor day and the `back` days before it. `on` is a date or a
    timestamp; the plain range on it prunes partitions or row groups."""
    return df.where((F.col(on) >= F.lit(anchor - timedelta(days=back))) & (F.col(on) < F.lit(anchor + timedelta(days=1))))


def at_offset(df: DataFrame, anchor: date, offset: int = FINISHED_OFFSET, on: str = "snapshot_date") -> DataFrame:
    return lookback(df, anchor - timedelta(days=offset), 0, on)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, broken rows)"""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def infer_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of one day as inferred, for a first look at a new source."""
    return spark.read.json(path).schema


def union_days(*days: DataFrame) -> DataFrame:
    """Days read apart, by column name; a column some day lacks is null there."""
    first, *rest = days
    for day in rest:
        first = first.unionByName(day, allowMissingColumns=True)
    return first


def snapshot_counts(df: DataFrame, on: str = "snapshot_date") -> DataFrame:
    return df.groupBy(on).agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
