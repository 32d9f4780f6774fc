"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def object_store_conf(endpoint: str, access_key: str | None = None, secret_key: str | None = None) -> dict[str, str]:
    """Settings of the S3A connector. Leave the keys out to use the cluster's
    own credential provider; nothing is read from code or files here."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: the session's `spark.checkpoint.dir`.
    Only a local-mode session without that setting gets a temporary folder."""
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="leafline-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """For heavy work per row, such as splitting text: a scan with fewer tasks than
    the cluster has cores has its rows dealt out evenly; any larger scan is
    left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files, so that
    later steps neither recompute it nor depend on its executors. The files stay
    until `clear_scratch`."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what `materialize` has written, once results that read it are stored."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# what a broadcast may take on an executor
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: texts and lists of texts by their length, 8 for others."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        text = f.dataType.simpleString()
        if text in ("string", "binary"):
            size = F.octet_length(f"`{f.name}`")
        elif text == "array<string>":
            size = F.aggregate(f"`{f.name}`", F.lit(0), lambda a, x: a + F.coalesce(F.octet_length(x), F.lit(0)) + 8)
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark `df` for broadcast if it has at most `max_rows` rows and `max_bytes`
    bytes, else leave the join to Spark. The count stops at the bound; `df`
    should be cheap to read."""
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["b"] or 0) <= max_bytes else df
