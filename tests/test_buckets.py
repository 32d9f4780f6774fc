"""Upserts that rewrite touched buckets only, and reruns of one day."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from leafline.sources import buckets as B
from leafline.operators.ranking import latest_per_key
from leafline.sources import daily_state as D
from leafline.sources import reruns as R


def items(spark, rows, schema="key long, item string"):
    return spark.createDataFrame(rows, schema)


def files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{base}/data") for f in names}


def test_untouched_buckets_are_shared(spark, tmp_path):
    base = str(tmp_path / "t")
    assert B.versions(spark, base) == []
    assert B.upsert_bucketed(spark, base, items(spark, [(i, f"a{i}") for i in range(60)] + [(None, "no key")]), "key", buckets=16) == 1
    before, first = files(base), B.folders(spark, base, 1)
    old = B.read_bucketed(spark, base, 1)
    news = items(spark, [(3, "b3"), (3, "c3"), (70, "b70")], "key long, item string").withColumn("extra", F.lit(1))
    assert B.upsert_bucketed(spark, base, news, "key", [F.col("item").desc()], buckets=99) == 2
    second = B.folders(spark, base, 2)
    touched = {r[0] for r in news.select(B.bucket_of("key", 16)).collect()}
    assert {b for b in second if second[b] != first.get(b)} == touched and len(first) > 12
    assert {k: v for k, v in files(base).items() if k in before} == before
    got = {r.key: (r.item, r.extra) for r in B.read_bucketed(spark, base).collect()}
    assert got == {**{i: (f"a{i}", None) for i in range(60)}, 3: ("c3", 1), 70: ("b70", 1)}
    assert {r.key: r.item for r in old.collect()} == {i: f"a{i}" for i in range(60)}
    some = B.read_bucketed(spark, base, only=sorted(touched)).select("key").collect()
    assert {3, 70} <= {r.key for r in some} and len(some) < 30


def test_no_updates_and_two_writers(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    B.upsert_bucketed(spark, base, items(spark, [(1, "a")]), "key", buckets=4)
    assert B.upsert_bucketed(spark, base, items(spark, []), "key") == 2
    assert B.folders(spark, base, 1) == B.folders(spark, base, 2)
    monkeypatch.setattr(B, "versions", lambda *a: [1])  # one that has not seen version 2
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        B.upsert_bucketed(spark, base, items(spark, [(1, "late")]), "key")
    assert [tuple(r) for r in B.read_bucketed(spark, base, 2).collect()] == [(1, "a")]


def test_a_rerun_replaces_its_own_day_only(spark, tmp_path):
    path = str(tmp_path / "days")
    assert R.complete_partitions(spark, path) is None
    days = spark.createDataFrame([(i, date(2024, 3, 1 + i % 3)) for i in range(30)], "id long, snapshot_date date")
    for d in (1, 2, 3):
        assert R.replace_partition(days, path, {"snapshot_date": date(2024, 3, d)}) == 10
    kept = {f: os.stat(f).st_mtime_ns for d in (1, 3) for f in map(str, (tmp_path / "days" / f"snapshot_date=2024-03-0{d}").iterdir())}
    again = spark.createDataFrame([(99, date(2024, 3, 2)), (98, date(2024, 3, 1))], "id long, snapshot_date date")
    assert R.replace_partition(again, path, {"snapshot_date": date(2024, 3, 2)}) == 1
    got = {(str(r.snapshot_date), r.id) for r in R.read_complete(spark, path).collect()}
    assert got == {(f"2024-03-0{1 + i % 3}", i) for i in range(30) if i % 3 != 1} | {("2024-03-02", 99)}
    assert kept == {f: os.stat(f).st_mtime_ns for f in kept}
    assert {(str(r.snapshot_date), r.n_rows) for r in R.complete_partitions(spark, path).collect()} == {
        ("2024-03-01", 10), ("2024-03-02", 1), ("2024-03-03", 10)
    }
    assert R.replace_partition(days.limit(0), path, {"snapshot_date": date(2024, 3, 3)}) == 0
    assert {str(r.snapshot_date) for r in R.read_complete(spark, path).collect()} == {"2024-03-01", "2024-03-02"}


def test_a_failed_rerun_leaves_no_marker(spark, tmp_path):
    path = str(tmp_path / "days")
    values = {"dataset": "fri", "snapshot_date": date(2024, 3, 1)}
    R.replace_partition(spark.range(3), path, values, "json")
    R.replace_partition(spark.range(2), path, {**values, "dataset": "sat"}, "json")
    broken = spark.range(2).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        R.replace_partition(broken, path, values, "json")
    assert [r.dataset for r in R.complete_partitions(spark, path).collect()] == ["sat"]
    assert {r.dataset for r in R.read_complete(spark, path, "json").collect()} == {"sat"}


def test_newest_rows_day_by_day(spark, tmp_path):
    """Over ten days, one missing and one run twice, always equal to the
    recomputation of the six days from their raw rows."""
    path, rnd, start = str(tmp_path / "state"), random.Random(4), date(2024, 1, 1)
    raw = {}
    order = [F.col("seq").desc()]
    schema = "key string, seq long, payload string, day date"

    def run(n):
        day = start + timedelta(days=n)
        raw[n] = [(rnd.choice([None, *"abcdefgh"]), i, f"{n}-{i}-{rnd.random()}", day) for i in range(rnd.randint(0, 12))]
        D.add_day(spark.createDataFrame(raw[n], schema), path, day, "key", order)

    with pytest.raises(ValueError):
        D.newest(spark, path, start, "key", order)
    for n in range(10):
        if n == 3:
            continue
        run(n)
        if n == 7:
            run(6)
        anchor = start + timedelta(days=n)
        window = [r for m, rows in raw.items() if n - 5 <= m <= n for r in rows if r[0] is not None]
        want = latest_per_key(spark.createDataFrame(window, schema), "key", [F.col("day").desc(), *order]).collect()
        assert sorted(map(tuple, D.newest(spark, path, anchor, "key", order).collect())) == sorted(map(tuple, want))
        gone = D.expire(spark, path, anchor)
        assert gone == ([start + timedelta(days=n - 6)] if n >= 6 and n - 6 != 3 else [])
