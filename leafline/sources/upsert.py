"""Keyed tables in which a later item replaces an earlier one as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.operators.ranking import latest_per_key
from leafline.session import broadcast_if_small, materialize


def upsert(
    existing: DataFrame, updates: DataFrame, key: str, order: Sequence[Column | str] | None = None
) -> DataFrame:
    """`existing` with every item of `updates` put in; columns an update lacks are
    null in the result, as the whole item is replaced. Updates are cut to one
    row per key (first in `order`), or are so already if no order is given, and
    stored once: their keys and their rows are both read from there. Existing rows
    only meet the update keys: where those are few, as after a usual day, the
    stored table is not shuffled. An item without a key cannot be stored."""
    new = updates.where(F.col(key).isNotNull())
    new = materialize(new if order is None else latest_per_key(new, key, order), "updates")
    kept = existing.join(broadcast_if_small(new.select(key)), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def version_path(base: str, version: int) -> str:
    return f"{base}/version={version:08d}"


def read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    return spark.read.parquet(version_path(base, version))


def publish(df: DataFrame, base: str, version: int) -> str:
    """Write a new version beside the old ones; readers of those are not disturbed."""
    path = version_path(base, version)
    df.write.mode("error").parquet(path)
    return path


def to_items(df: DataFrame, key: str) -> DataFrame:
    """(key, item): each row as a JSON document."""
    return df.select(key, F.to_json(F.struct(*df.columns)).alias("item"))
