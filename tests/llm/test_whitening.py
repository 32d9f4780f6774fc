"""Whitening against the eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from leafline.llm import queries as Q
from leafline.llm import whitening as W

SF_DIR = "/root/testdata/sf0.001"


def brute(vectors, k=8):
    """{component: (explained, whitened by row)}, n, deviations, from the whole matrix."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    c = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    values, e = np.linalg.eigh(c.T @ c / n)
    values, e = values[::-1][:k], e[:, ::-1][:, :k]
    return c @ e / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(c.T @ c / n), deviation


def check(got, vectors, k, accuracy=1e-9):
    white, explained, deviation = brute(list(vectors.values()), k)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == len(vectors) * k and {c for _, c in by} == set(range(1, k + 1))
    for j in range(k):
        mine = np.array([by[i, j + 1].whitened for i in vectors])
        sign = np.sign(mine @ white[:, j])
        assert np.abs(mine * sign - white[:, j]).max() < accuracy
    for i, d in zip(vectors, deviation):
        r = by[i, 1]
        assert r.n == len(vectors) and r.deviation == d and r.explained == pytest.approx(explained[0], rel=1e-10)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-10


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(Q.op12_embedding_whitening(spark, SF_DIR).collect(), {r.vec_id: r.embedding for r in rows}, 8)


SCHEMA = "vec_id long, embedding array<double>, component int, n string, x int, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 2, 3) for i, v in rows], SCHEMA)


def cloud(seed, n, d, scale):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return {i: v.tolist() for i, v in enumerate(rng.standard_normal((n, d)) * np.resize(scale, d) @ turn.T)}


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BYTES", 500)
    good = cloud(1, 60, 12, [8, 5, 3, 2, 1])
    odd = [
        (100, None), (101, []), (102, [1.0] * 11), (103, [1.0] * 11 + [None]), (104, [math.nan] * 12), (105, [math.inf] + [0.0] * 11),
        (None, [0.5] * 12), (None, None), (0, [0.25] * 12), (0, good[0]),
    ]
    rows = [*good.items(), *odd]
    got = W.whiten(frame(spark, rows).repartition(5)).collect()
    kept = [v for _, v in rows if v is not None and len(v) == 12 and all(c is not None and math.isfinite(c) for c in v)]
    assert len(got) == 8 * len(kept) and {r.vec_id for r in got} == {None, *range(60)}
    white, explained, deviation = brute(kept)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    for j in range(8):
        mine = np.sort([r.whitened for r in got if r.component == j + 1])
        assert min(np.abs(mine - np.sort(s * white[:, j])).max() for s in (1, -1)) < 1e-9
    floats = frame(spark, rows).selectExpr("vec_id", "cast(embedding as array<float>) AS embedding")
    assert W.whiten(floats).count() == len(got)


def test_few_dimensions_and_no_variance(spark):
    three = cloud(2, 30, 3, [4, 2, 1])
    check(W.whiten(frame(spark, list(three.items()))).collect(), three, 3)
    flat = {i: [float(a), float(b), float(a + b), 7.0] for i, (a, b) in enumerate((a, b) for a in range(9) for b in range(4))}
    check(W.whiten(frame(spark, list(flat.items()))).collect(), flat, 2)  # the rank is two
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = W.whiten(frame(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0


def test_large_entries(spark):
    rows = [(i, [1e30 if i == 0 else float(i % 5), -3.0e6 * (i % 3), float(i)]) for i in range(20)]
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == 40 and {r.deviation is None for r in got if r.vec_id == 0} == {True}
    exact = brute([[min(v[0], 2.0**30), *v[1:]] for _, v in rows], 3)[2]
    assert all(r.deviation == exact[r.vec_id] for r in got if r.deviation is not None)


def dense(values, seed=0):
    """A covariance with the given eigenvalues, and its eigenvectors."""
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return turn * np.array(values, float) @ turn.T, turn


SPECTRA = {
    "flat": np.linspace(1.0, 0.9, 120),
    "steep": 10.0 ** -np.linspace(0, 8, 120),
    "steps": np.repeat(10.0 ** -np.arange(12), 10) * np.tile(np.linspace(1, 0.5, 10), 12),
    "rank": np.concatenate([np.arange(10, 0, -1), np.zeros(110)]),
    "close": np.concatenate([1 + 1e-4 * np.arange(40, 0, -1), np.linspace(0.99, 0.1, 80)]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_filtered_iteration_is_certified(name):
    values = np.sort(SPECTRA[name])[::-1]
    matrix, turn = dense(values)
    q, found, residual, passes = W.filtered_iteration(lambda b: matrix @ b, 120, 8)
    assert np.abs(found - values[:8]).max() < 1e-13 * values[0] and residual < 1e-11 and passes < 200
    for j in range(8):
        gap = min(abs(values[j] - v) for i, v in enumerate(values) if i != j)
        assert np.abs(np.abs(q[:, j] @ turn[:, j]) - 1) < 1e-8 + (residual * values[0] / gap) ** 2 * 10


def test_equal_values_need_few_passes():
    matrix, _ = dense(np.ones(100))
    q, found, residual, passes = W.filtered_iteration(lambda b: matrix @ b, 100, 8)
    assert np.allclose(found, 1) and np.allclose(q.T @ q, np.eye(8)) and passes <= 40 and residual < 1e-11


def test_whole_texts_of_blocks(spark):
    """Blocks hold every sound vector once, in the narrowest numbers."""
    rows = [(1, [1.0, -1.0]), (2, [100.0, 0.0]), (3, [1e7, 0.0]), (4, [None, 1.0])]
    blocks = W.pack(frame(spark, rows).repartition(4)).collect()
    assert sorted((b.ids, b.width) for b in blocks) == [([1], 2), ([2], 4), ([3], 8)]
