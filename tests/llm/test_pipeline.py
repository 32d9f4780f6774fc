import pyarrow as pa
import pytest

import corpus_pipeline as P
from leafline.llm import queries as Q
from suite.compare import duck, rows
from tests.llm.helpers import ODD, empty, frame

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, SF_DIR), name)
        sizes.append(docs.count())
        if name != "sharding":
            assert docs.columns == columns
    assert sizes[1] <= sizes[0] and sizes[3] <= sizes[2] < sizes[1] and sizes[4] == sizes[5] > 0
    assert sorted({r.shard for r in docs.collect()}) == list(range(P.SHARDS))


@pytest.mark.parametrize("odd", [True, False])
def test_stages_on_odd_rows(spark, odd):
    docs = frame(spark, ODD) if odd else empty(spark)
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, SF_DIR), name)
    assert (docs.count() > 0) == odd


@pytest.mark.parametrize("name", ["language_id", "near_duplicates", "benchmark_leaks"])
def test_long_texts_come_to_python_in_small_batches(spark, name):
    """Whatever a stage hands to Python is bounded by bytes, not by rows alone."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    docs = frame(spark, [(i, f"word{i} " * 300, "en", "s") for i in range(4000)]).coalesce(1)
    spark.conf.unset(P.BATCH)
    try:
        dict(P.STAGES)[name](spark, docs, SF_DIR)
        got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.unset(P.BATCH)
    assert len(got) > 1 and max(got) < 1.5 * P.BATCH_BYTES


def test_run_leaves_the_session_as_it_was(spark, monkeypatch):
    monkeypatch.setattr(P, "STAGES", P.STAGES[:1])
    for value in (None, "12345678"):
        spark.conf.unset(P.BATCH) if value is None else spark.conf.set(P.BATCH, value)
        try:
            assert P.run(spark, SF_DIR).count() > 0
            assert spark.conf.get(P.BATCH, None) == value
        finally:
            spark.conf.unset(P.BATCH)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_same_as_sql(spark, name):
    got, rel = Q.QUERIES[name](spark, SF_DIR), duck(SF_DIR).sql(Q.ORACLES[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(rel.columns, rel.fetchall())


def test_names():
    numbers = [int(n[2:].split("_")[0]) for n in Q.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
