import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafline.llm import text as T
from tests.llm.helpers import ODD, words

TEXTS = [r[1] for r in ODD] + ["a b", " a b", "a b ", "\x0ba\x0cb\r", "É Éa A\u00a0B"]


def test_words_in_tasks_and_in_spark(spark):
    flat, offsets = T.words(pa.array(TEXTS, pa.string()))
    got = [flat[int(a) : int(z)].to_pylist() for a, z in zip(offsets, offsets[1:])]
    assert got == [words(t) for t in TEXTS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    counts = [r.n for r in df.select("i", T.word_count(F.col("t")).alias("n")).orderBy("i").collect()]
    assert counts == [len(words(t)) for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0caAbé\x1f\u00a0", max_size=12)), max_size=6))
def test_words_of_any_text(texts):
    flat, offsets = T.words(pa.array(texts, pa.string()))
    assert [flat[int(a) : int(z)].to_pylist() for a, z in zip(offsets, offsets[1:])] == [words(t) for t in texts]


def test_chunks_keep_all_rows_and_a_bound():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 50, 1, 1, 1)] + [None])], ["text"])
    parts = list(T.chunks(iter([batch]), "text", 10))
    assert [p.num_rows for p in parts] == [1, 1, 4]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_hashes_depend_on_bytes_only():
    a = T.hash_bytes(pa.array(["ab", "", "abc", "ba"]))
    b = T.hash_bytes(pa.array(["x", "abc", "ab", "ba", ""])[1:])
    assert len(set(a.tolist())) == 4 and a[[2, 0, 3, 1]].tolist() == b.tolist()


def test_segment_sums():
    assert T.segment_sums(np.array([1.0, 2.0, 3.0]), np.array([0, 0, 2, 3])).tolist() == [0.0, 3.0, 3.0]
    with pytest.raises(IndexError):
        T.segment_sums(np.array([1.0]), np.array([0, 5]))


def test_words_of_slices():
    """Chunks are slices of a batch; each must read its own texts."""
    from leafline.llm import near_dup, token_scan

    texts = [f"{'É a B' * (i % 7)} text{i} Ab{i}" if i % 5 else None for i in range(500)]
    whole = pa.array(texts, pa.string())
    for a, n in ((0, 500), (1, 100), (250, 250), (499, 1)):
        part, fresh = whole.slice(a, n), pa.array(texts[a : a + n], pa.string())
        for f in (T.words, T.bare_words):
            (flat, offsets), (want, want_offsets) = f(part), f(fresh)
            assert flat.to_pylist() == want.to_pylist() and offsets.tolist() == want_offsets.tolist()
        assert T.words(part)[0].to_pylist() == [w for t in texts[a : a + n] for w in words(t)]
        assert [s.tolist() for s in near_dup.shingle_sets(part)] == [s.tolist() for s in near_dup.shingle_sets(fresh)]
        assert token_scan.token_ids(part)[0].tolist() == token_scan.token_ids(fresh)[0].tolist()
