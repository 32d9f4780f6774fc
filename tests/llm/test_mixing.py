from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.llm import mixing as M
from tests.llm.helpers import ALL, ODD, empty, frame, ids, words


def targets(sizes, weights=M.WEIGHTS, share=M.SHARE, most=M.MOST):
    """Fill up by weight, cut at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return {**out, **{s: left * w[s] / total for s in open_}}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = np.random.default_rng(seed)
    sizes = {(None if i == 3 else f"s{i}"): int(rnd.choice([0, 1, 5, 40, 1000])) for i in range(2 + 3 * seed)}
    rows = [(s, n) for s, n in sizes.items()] + [(s, 0) for s in sizes]
    got = M.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    want = targets(sizes)
    assert {r.source for r in got} == set(sizes) and all(r.n == 2 for r in got)
    assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) for r in got)


def planted(spark, seed=0, n=900):
    rnd = np.random.default_rng(seed)
    names = ["a"] * 5 + ["b", "c", None, "é"]
    rows = [(int(i), " ".join(["w"] * int(rnd.choice([0, 3, 20, 100, 500], p=[0.05, 0.4, 0.4, 0.14, 0.01]))), "en", names[rnd.integers(9)]) for i in range(n)]
    return rows


@pytest.mark.parametrize("fan_in", [64, 5])
def test_mix(spark, monkeypatch, fan_in):
    monkeypatch.setattr(M, "FAN_IN", fan_in)
    rows = planted(spark)
    got = M.mix(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    size, source = {r[0]: len(words(r[1])) for r in rows}, {r[0]: r[3] for r in rows}
    sums, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sums[source[i]] += n
    want = targets(sums)
    for r in got:
        s = source[r.doc_id]
        assert r.source == s and r.size == size[r.doc_id] and r.source_size == sums[s] and abs(r.target - want[s]) < 1e-6
        assert r.copies in (int(want[s] // sums[s]), int(want[s] // sums[s]) + 1) and r.taken == r.copies * r.size <= 2 * r.size
        taken[s] += r.taken
        if r.size <= M.BIG * sums[s]:
            largest[s] = max(largest[s], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sums)
    again = M.mix(frame(spark, rows[::-1]).repartition(7)).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in got}


def test_draws_keep_the_average(spark):
    """Over many sources of the same make, each place is taken as often as its share."""
    folds = spark.range(4000).select(
        F.concat(F.lit("s"), "id").alias("source"), F.lit(0).alias("chunk"),
        F.explode(F.array(*[F.struct(F.lit(float(s)).alias("s"), F.lit(i).alias("i")) for i, s in enumerate([50, 5, 30, 5, 10])])).alias("x"),
    ).select("source", "chunk", F.col("x.i").cast("long").alias("h"), F.struct(F.col("x.i").alias("i")).alias("d"), "x.s", F.lit(0.4).alias("p"),
             M.uniform(F.col("source"), F.col("x.i")).alias("u"))
    folded = M._fold(folds)
    mass, mean = Counter(), Counter()
    for r in folded.collect():
        assert len(r.o) == 4
        sizes = [50, 5, 30, 5, 10]
        assert abs(sum(sizes[x.d.i] * x.k for x in r.o) + sizes[r.c.d.i] * r.c.p - 40) < 1e-9
        for x in r.o:
            mean[x.d.i] += x.k
        mean[r.c.d.i] += r.c.p
        mass[r.c.d.i] += 1
    assert all(abs(mean[i] / 4000 - 0.4) < 0.03 for i in range(5))


def test_odd_rows(spark):
    rows = M.mix(frame(spark, ODD)).collect()
    assert ids(rows) == ALL and all(r.copies in (0, 1, 2) for r in rows)
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert M.mix(empty(spark)).count() == 0
    assert M.mix(frame(spark, [(1, None, None, None), (2, "", None, "b")])).count() == 2
    with pytest.raises(ValueError):
        M.source_targets(spark.createDataFrame([("a", 1)], "source string, size long"), share=3.0)


def test_rows_come_as_often_as_they_are_taken(spark):
    docs = frame(spark, ODD + planted(spark, 3, 120))
    out = M.take_copies(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in M.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert M.take_copies(empty(spark)).count() == 0


def test_no_python_in_the_mix(spark):
    plan = M.mix(frame(spark, ODD))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "CartesianProduct"))
