"""Exact duplicates by progressive refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm.text import ascii_lower
from leafline.session import broadcast_if_small, materialize

#: characters of a text that the second step looks at
PREFIX = 64
#: a text that more than one in so many rows hold is crowded; there are fewer such texts than this
CROWDED = 1000


def normal(text: Column) -> Column:
    """Null counts as empty; A to Z become lower case."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("__c")).where("__c > 1").select(*keys)


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> tuple[DataFrame, DataFrame]:
    """(survivors, groups) of texts that are equal after A to Z become lower case.

    survivors: doc_id, length, digest of every document whose length and first
    `prefix` characters another document shares. groups: length, digest, keep_id
    (the largest doc_id), group_size of every text that occurs twice or more.

    Three steps, each over what the one before could not tell apart: length in
    bytes; a hash of the first characters; SHA-256 of the whole text, which only
    survivors pay for. What is shuffled are lengths and hashes, summed in each
    task first, so a text held by a third of all rows costs one row per task.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).alias("length"), F.col(text).alias("text")
    )
    lengths = materialize(_repeated(base, ["length"]), "lengths")
    sized = base.join(broadcast_if_small(lengths), "length", "left_semi")
    sized = sized.withColumn("head", F.xxhash64(normal(F.substring("text", 1, prefix))))
    heads = materialize(_repeated(sized, ["length", "head"]), "heads")
    alike = sized.join(broadcast_if_small(heads), ["length", "head"], "left_semi")
    survivors = materialize(alike.select("doc_id", "length", F.unhex(F.sha2(normal(F.col("text")), 256)).alias("digest")), "digests")
    groups = (
        survivors.groupBy("length", "digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    return survivors, groups


def _with_group(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Each row with the keep_id and group_size of its text. Crowded texts are fewer
    than CROWDED and go to the rows; rows that have found theirs are dealt out
    evenly by length -1 and less, which no text has, so that no task gets a whole crowded group."""
    crowded = F.col("group_size") * CROWDED > total
    keys = ["length", "digest"]
    few = groups.where(crowded).select(*keys, F.col("keep_id").alias("k"), F.col("group_size").alias("g"))
    found = rows.join(F.broadcast(few), keys, "left")
    spot = F.when(F.col("g").isNull(), F.col("length")).otherwise(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))
    rest = groups.where(~crowded).withColumnRenamed("length", "spot")
    out = found.withColumn("spot", spot).join(rest, ["spot", "digest"], "left")
    keep = F.when(F.col("g").isNull(), F.col("keep_id")).otherwise(F.col("k"))
    return out.select("doc_id", *keys, keep.alias("keep_id"), F.coalesce("g", "group_size").alias("group_size"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `docs`.
    Of equal texts the row with the largest doc_id stays; a null id is less than
    any other, and where all ids of a group are null all its rows stay. A
    repeated doc_id counts once per row, and its rows stay or go together. Null texts are equal to
    empty ones. No rows give no rows; other columns are not looked at."""
    _, groups = duplicate_groups(docs, doc_id, text, prefix)
    every = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).alias("length"),
        F.unhex(F.sha2(normal(F.col(text)), 256)).alias("digest"),
    )
    out = _with_group(every, materialize(groups, "groups"), docs.count())
    single = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(single, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
