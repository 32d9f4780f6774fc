from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafline.sources.snapshots import read_table

Query = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, tuple[Query, str | None]] = {}


def case(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL of its result."""

    def add(fn: Query) -> Query:
        assert fn.__name__ not in CASES, fn.__name__
        CASES[fn.__name__] = (fn, sql)
        return fn

    return add


TEXTS = {"documents", "conversations", "pages"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", spread=name in TEXTS)
