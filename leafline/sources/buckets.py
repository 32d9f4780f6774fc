"""Keyed tables in buckets: a new version writes the buckets that its updates touch
and shares the files of all others with the version before.

A table folder holds `data`, one folder per write, and `versions`, one small file list
(bucket, folder) per version. A version is there once its list is; the files of
older ones are never changed, so their readers are not disturbed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.operators.ranking import latest_per_key
from leafline.session import broadcast_if_small, materialize

BUCKETS = 256
_LIST = "bucket int, buckets int, folder string"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def versions(spark: SparkSession, base: str) -> list[int]:
    """The versions that are complete."""
    try:
        found = spark.read.schema(_LIST + ", version int").json(f"{base}/versions")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted(r["version"] for r in found.select("version").distinct().collect())


def folders(spark: SparkSession, base: str, version: int) -> dict[int, str]:
    """The folder of each bucket that holds rows, under the table's."""
    return {r["bucket"]: r["folder"] for r in _list_of(spark, base, version)}


def _list_of(spark: SparkSession, base: str, version: int) -> list:
    # a row per bucket
    return spark.read.schema(_LIST).json(f"{base}/versions/version={version}").collect()


def read_bucketed(spark: SparkSession, base: str, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """A version, by default the last; `only` some of its buckets. A column that
    came in with a later version is null in older rows."""
    version = versions(spark, base)[-1] if version is None else version
    paths = [f"{base}/{f}" for b, f in folders(spark, base, version).items() if only is None or b in only]
    return spark.read.option("mergeSchema", True).parquet(*paths)


def upsert_bucketed(
    spark: SparkSession, base: str, updates: DataFrame, key: str, order: Sequence[Column | str] | None = None, buckets: int = BUCKETS
) -> int:
    """Put every item of `updates` into the table and return the new version's number.
    Updates are cut to one row per key (first in `order`), or are so already if no
    order is given; an item replaces an earlier one as a whole, and without a key it
    cannot be stored. The number of buckets is fixed by the first version. Two writers of
    one version: the second fails, and its files belong to no version."""
    known = versions(spark, base)
    listed = _list_of(spark, base, known[-1]) if known else []
    buckets = listed[0]["buckets"] if listed else buckets
    new = updates.where(F.col(key).isNotNull())
    new = materialize(new if order is None else latest_per_key(new, key, order), "updates")
    touched = {r[0] for r in new.select(bucket_of(key, buckets)).distinct().collect()}  # of `buckets` at most
    had = {r["bucket"]: r["folder"] for r in listed}
    rows = new
    stored = [had[b] for b in touched if b in had]
    if stored:
        old = spark.read.option("mergeSchema", True).parquet(*[f"{base}/{f}" for f in stored])
        rows = old.join(broadcast_if_small(new.select(key)), key, "left_anti").unionByName(new, allowMissingColumns=True)
    if touched:
        folder = f"data/{uuid.uuid4().hex}"
        rows.withColumn("__bucket", bucket_of(key, buckets)).hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(f"{base}/{folder}")
        had |= {b: f"{folder}/__bucket={b}" for b in touched}
    version = known[-1] + 1 if known else 1
    entries = spark.createDataFrame([(b, buckets, f) for b, f in sorted(had.items())], _LIST)
    entries.coalesce(1).write.mode("error").json(f"{base}/versions/version={version}")
    return version
