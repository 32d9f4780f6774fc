"""The daily jobs run on whatever days have newly arrived.

A trigger that takes all new files and stops stands in for the outside daily
scheduler: each run handles the days that are new since the last one, and the
stream's checkpoint keeps account of them, also across lost drivers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leafline.sources.snapshots import date_of_path


def stream_days(spark: SparkSession, pattern: str, schema: StructType, style: str) -> DataFrame:
    """Snapshot files as a stream, with `snapshot_date` from each file's path.
    `pattern` is a path or glob of the day files."""
    return spark.readStream.schema(schema).json(pattern).withColumn("snapshot_date", date_of_path(style))


def run_new_days(days: DataFrame, job: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Apply a row-wise job to the new days and append its rows, one folder per
    day. The file sink's log makes a repeated batch write its rows once."""
    return (
        job(days)
        .writeStream.format("parquet")
        .partitionBy("snapshot_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
