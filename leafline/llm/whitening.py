"""Principal components of vectors, and the vectors whitened by them.

The components come from subspace iteration with Chebyshev filters: a polynomial of the
covariance that is small on the unwanted part of the spectrum is applied to a
block of vectors, one pass over the data for each degree, until the residuals of
the wanted components certify them. The covariance itself is never formed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.session import materialize

COMPONENTS = 8
#: an entry c counts as floor(SCALE * c) + SHIFT, a whole number
SCALE, SHIFT = 1024, 100_000
#: larger entries than this, by size, count as this
LARGEST = float(1 << 30)
#: bytes of numbers in a block of vectors, at most (one vector, at least)
BLOCK_BYTES = 2 << 20
#: vectors in the block for each component wanted, and passes of a filter
BLOCK, DEGREE = 4, 8
#: components are certified at residuals of this part of the largest eigenvalue, or,
#: when rounding keeps them above it, below ROUNDING where they no longer fall
CERTIFIED, ROUNDING = 3e-15, 1e-11
#: variance of this part of the largest eigenvalue is none
NOTHING = 1e-12
#: filters before the block is doubled; at full size one pass is exact
PATIENCE = 8


@dataclass
class Whitening:
    dim: int
    n: int
    sums: list[int]  # of the entries without SHIFT, exact
    components: np.ndarray  # (dim, k), unit columns by falling eigenvalue
    values: np.ndarray
    trace: float
    residual: float  # the largest, as a part of the largest eigenvalue
    passes: int


def pack(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(dim, ids, width, x): the vectors as blocks of whole numbers without
    SHIFT, `width` bytes each. Vectors that are null or hold null or non-finite
    entries are left out."""
    element = vectors.schema[vector].dataType.elementType.simpleString()
    values = F.col(vector) if element in ("float", "double") else F.col(vector).cast("array<double>")
    slim = vectors.select(F.col(vec_id).alias("vec_id"), values.alias("v")).where(F.col("v").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for b in batches:
            lists, ids = b.column("v"), b.column("vec_id")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            sound = bad[ends] == bad[ends - sizes]
            for dim in np.unique(sizes[sound]).tolist():
                rows = np.flatnonzero(sound & (sizes == dim))
                step = max(1, BLOCK_BYTES // max(1, 8 * dim))
                for at in (rows[i : i + step] for i in range(0, len(rows), step)):
                    c = np.clip(flat[(ends - sizes)[at][:, None] + np.arange(dim)], -LARGEST, LARGEST)
                    x = np.floor(c * SCALE).astype(np.int64)
                    top = int(np.abs(x).max(initial=0))
                    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
                    taken = ids.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), taken),
                         pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([x.astype(kind).tobytes()], pa.binary())],
                        ["dim", "ids", "width", "x"],
                    )

    kind = vectors.schema[vec_id].dataType.simpleString()
    return slim.mapInArrow(run, f"dim int, ids array<{kind}>, width int, x binary")


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers without SHIFT) of each block."""
    for b in batches:
        for ids, width, x in zip(b.column("ids"), b.column("width").to_pylist(), b.column("x")):
            yield ids.values, np.frombuffer(x.as_buffer(), f"<i{width}").astype(np.int64).reshape(len(ids.values), dim)


def _centred(dim: int, n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n of whole numbers, with one rounding: the mean's whole part is taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole).astype(np.float64) - part


def _sum_over(blocks: DataFrame, dim: int, width: int, per_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of a (rows, width) matrix that is made of each: one
    matrix for each task, summed by row in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, dim):
            part = per_block(x)
            total = part if total is None else total + part
        if total is not None:
            lists = pa.FixedSizeListArray.from_arrays(pa.array(total.reshape(-1)), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), lists], ["i", "v"])

    rows = blocks.mapInArrow(run, "i int, v array<double>")
    summed = rows.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"c{j}") for j in range(width)]).toArrow().sort_by("i")
    return np.column_stack([summed[f"c{j}"].to_numpy() for j in range(width)])


def _fit_list(blocks: DataFrame) -> tuple[int, int, list[int]]:
    """(dim, n, exact sums) of the vectors of the most frequent length, the
    longer one of two as frequent."""
    sizes = blocks.groupBy("dim").agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if sizes is None or not sizes["dim"]:
        return 0, sizes["n"] if sizes else 0, []
    dim = sizes["dim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for _, x in _matrices(batches, dim):
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total])], ["i", "s"])

    of_dim = blocks.where(F.col("dim") == dim)
    rows = of_dim.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["i"]: int(r["s"]) for r in rows}
    return dim, sizes["n"], [sums[i] for i in range(dim)]


class _Covariance:
    """The covariance as a product with blocks of vectors, one pass each. Beside
    the block each pass carries one vector of a Lanczos process, whose least
    Ritz value bounds the spectrum from below, for no pass of its own."""

    def __init__(self, times: Callable[[np.ndarray], np.ndarray], dim: int, seed: int):
        self.times, self.dim, self.passes = times, dim, 0
        z = np.random.default_rng(seed + 1).standard_normal(dim)
        self.basis, self.diagonal, self.beside = [z / np.linalg.norm(z)], [], []

    def __call__(self, block: np.ndarray) -> np.ndarray:
        self.passes += 1
        if len(self.basis) == len(self.diagonal):  # the process has come to its end
            return self.times(block)
        out = self.times(np.column_stack([block, self.basis[-1]]))
        w, known = out[:, -1], np.array(self.basis)
        self.diagonal.append(float(known[-1] @ w))
        for _ in range(2):
            w = w - known.T @ (known @ w)
        size = float(np.linalg.norm(w))
        self.beside.append(size)
        if len(known) < min(self.dim, 4 * DEGREE) and size > 1e-10 * abs(self.diagonal[0]):
            self.basis.append(w / size)
        return out[:, :-1]

    def least(self) -> float:
        """About the least eigenvalue, from below."""
        inner = self.beside[:-1]
        values, vectors = np.linalg.eigh(np.diag(self.diagonal) + np.diag(inner, 1) + np.diag(inner, -1))
        return max(0.0, float(values[0] - abs(self.beside[-1] * vectors[-1, 0])))


def filtered_iteration(times: Callable[[np.ndarray], np.ndarray], dim: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(components, values, residual, passes): the k largest eigenvalues of a
    covariance given as `times`, its product with a block of vectors.

    Each round is Rayleigh-Ritz on the block (its product is reused as the
    filter's first step), then a Chebyshev polynomial by its three-term recurrence
    on the interval of the unwanted values, then QR. The interval ends at the least
    Ritz value of the block. The degree is kept so low that the
    largest component, which grows most, does not drown the others."""
    covariance, rng = _Covariance(times, dim, seed), np.random.default_rng(seed)
    width, rounds, last = min(dim, BLOCK * k), 0, math.inf
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    while True:
        w = covariance(q)
        ritz, turn = np.linalg.eigh((q.T @ w + w.T @ q) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, w, top = q @ turn, w @ turn, max(float(ritz[0]), 1e-300)
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * ritz[:k], axis=0).max() / top)
        if width == dim or residual <= CERTIFIED or residual <= ROUNDING and residual > last / 4:
            return q[:, :k], np.maximum(ritz[:k], 0.0), residual, covariance.passes
        last, rounds = residual, rounds + 1
        low, high = covariance.least(), float(ritz[-1])
        low = low if low < high else 0.0
        middle, half = (low + high) / 2, max((high - low) / 2, NOTHING * top)
        grow = [math.acosh(max(1.0, (float(v) - middle) / half)) for v in (ritz[0], ritz[k - 1])]
        degree = min(DEGREE, max(1, int(18 / max(grow[0] - grow[1], 1e-9))))
        # scaled so that the largest component keeps its size
        first = scale = half / max(top - middle, half)
        before, q = q, (w - middle * q) * (scale / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - scale)
            before, q = q, (covariance(q) - middle * q) * (2 * after / half) - before * (scale * after)
            scale = after
        if rounds % PATIENCE == 0:
            width = min(dim, 2 * width)
            q = np.column_stack([q, rng.standard_normal((dim, width - q.shape[1]))])
        q = np.linalg.qr(q)[0]


def fit(blocks: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of the vectors in `blocks` (from `pack`): unit eigenvectors
    of the covariance with divisor n, certified by their residuals, the largest
    entry of each positive. Vectors of another length than the most frequent one
    are not looked at. Components without variance are left out; without any
    there is no model. Only matrices of dim rows and a few columns come to the driver."""
    dim, n, sums = _fit_list(blocks)
    if not n or not dim:
        return None
    mine, centred = blocks.where(F.col("dim") == dim), _centred(dim, n, sums)
    trace = float(_sum_over(mine, dim, 1, lambda x: np.array([[np.square(centred(x)).sum()]]))[0, 0]) / n
    if trace <= 0:
        return None

    def times(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ q)

        return _sum_over(mine, dim, q.shape[1], part) / n

    vectors, values, residual, passes = filtered_iteration(times, dim, min(components, dim))
    some = values > NOTHING * values[0]
    vectors, values = vectors[:, some], values[some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return Whitening(dim, n, sums, vectors, values, trace, residual, passes)


def _project(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centred, scaled = _centred(model.dim, model.n, model.sums), model.components / np.sqrt(model.values)
    return lambda x: centred(x) @ scaled


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    project, k = _project(model), len(model.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = project(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = _sum_over(blocks.where(F.col("dim") == model.dim), model.dim, k, moments) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def transform(blocks: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every vector: the sum over dimensions of
    (n x - S)^2, exact, null where it does not fit a long; and its distance from the mean along
    each component over the component's standard deviation."""
    dim, n, project = model.dim, model.n, _project(model)
    whole = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([s % n for s in model.sums], np.int64)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, dim):
            w = pa.FixedSizeListArray.from_arrays(pa.array(project(x).reshape(-1)), k).cast(pa.list_(pa.float64()))
            away = x - whole
            size = (np.square(away.astype(np.float64) * n - rest)).sum(axis=1)
            fits = size < 9e18
            away = np.where(fits[:, None], away, 0)
            deviation = pa.array(np.square(away * n - np.where(fits[:, None], rest, 0)).sum(axis=1), mask=~fits)
            yield pa.RecordBatch.from_arrays([ids, deviation, w], ["vec_id", "deviation", "whitened"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = blocks.where(F.col("dim") == dim)
    return rows.mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a
    row for every vector that is left and every component with variance, at most `components`.

    Vectors that are null or hold null or non-finite entries are left out, and
    those of another length than the most frequent one (of two as frequent, the
    longer). Entries beyond 2^30 count as 2^30. Equal eigenvalues have any
    orthogonal components, the same for all rows. Null and repeated ids are
    rows like others; other columns are not looked at. No vectors, or only equal
    ones, give no rows."""
    blocks = materialize(pack(vectors, vec_id, vector), "vector-blocks")
    model = fit(blocks, components)
    if model is None:
        kind = vectors.schema[vec_id].dataType.simpleString()
        schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    rows = transform(blocks, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("at") + 1)
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(identity_error(blocks, model)).alias("identity_error"),
    )
