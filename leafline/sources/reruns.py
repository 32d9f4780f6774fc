"""One day's output written again: its own folder is replaced, nothing else, and a
marker tells readers which days are complete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MARKERS = "_complete"


def observed(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    """`df` with aggregates of its rows that are taken while it is written, so that
    counting needs no scan of its own."""
    seen = Observation()
    return df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), seen


def _folder(values: Mapping[str, object]) -> str:
    return "/".join(f"{k}={v}" for k, v in values.items())


def replace_partition(df: DataFrame, path: str, values: Mapping[str, object], file_format: str = "parquet") -> int:
    """Write the rows of `df` that belong to one partition, such as one day, in place of
    what it held, also where there are none now, and return their number.
    `values` name the partition columns in the order of folders. The partition's
    marker goes before the first file does and comes back after the last."""
    spark, names = df.sparkSession, list(values)
    mine = df
    for name, value in values.items():
        if name in df.columns:
            mine = mine.where(F.col(name) == F.lit(value))
    mine, seen = observed(mine.drop(*names), rows=F.count(F.lit(1)))
    marker = f"{path}/{MARKERS}/{_folder(values)}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(marker)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    mine.write.mode("overwrite").format(file_format).save(f"{path}/{_folder(values)}")
    rows = seen.get["rows"]
    spark.createDataFrame([(rows,)], "n_rows long").coalesce(1).write.json(marker)
    return rows


def complete_partitions(spark: SparkSession, path: str) -> DataFrame | None:
    """The complete partitions with their `n_rows`; None if there are none."""
    try:
        return spark.read.json(f"{path}/{MARKERS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def read_complete(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame | None:
    """The rows of complete partitions; their number, days mostly, is small."""
    done = complete_partitions(spark, path)
    if done is None:
        return None
    names = [c for c in done.columns if c != "n_rows"]
    return spark.read.format(file_format).load(path).join(F.broadcast(done.select(*names)), names, "left_semi")
