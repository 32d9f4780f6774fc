"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on, with the
columns of `documents`; the last returns each row's place in the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafline.llm import lang_id, leaks, mixing, near_dup, sharding
from leafline.llm.text import table
from leafline.session import materialize

SHARDS = 24
#: bytes of a batch of rows on its way to Python and back, which executors hold several times;
#: rows alone, 10,000 of them, make batches of long texts large
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """From here on batches are bounded by bytes. Spark looks this up when the caller runs
    a stage's result, so a stage cannot put it back."""
    spark.conf.set(BATCH, str(BATCH_BYTES))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones, all of which are
    learned from, are in."""
    bound_batches(spark)
    known = lang_id.labelled(docs)
    model = lang_id.fit_labelled(known)
    return lang_id.keep_determined(docs, model, lang_id.typical_level(known, model))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id."""
    bound_batches(spark)
    return near_dup.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bound_batches(spark)
    found = leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where("size(leaks) = 0").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take_copies(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("benchmark_leaks", without_leaks),
    ("mix_sources", mixed),
    ("sharding", sharded),
]

#: the stages train models and draw at random, which SQL cannot say
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH, None)
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    finally:  # all stages are stored
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)
    return docs
