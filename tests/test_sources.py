import csv
import json
import random
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leafline import schemas as SC
from leafline.functions.dates import COMPACT, DASHED
from leafline.session import object_store_conf, scratch_path, shared_dir
from leafline.sources import sinks as K
from leafline.sources import snapshots as S
from leafline.sources import upsert as U

ANCHOR = date(2024, 3, 10)


def write_day(folder, day, records, style=COMPACT):
    # one JSON array on one line, as the crawlers store it
    (folder / f"{day.strftime(style)}.json").write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")


def record(i, **more):
    return {"t_IDs": i, "t_names": f"n{i}", "t_comments": ["좋아요 ㅋㅋ", "b\nc"], "t_weekdays": ["mon"], **more}


def test_lookback_skips_missing_days_and_ignores_older(spark, tmp_path):
    for back in (0, 2, 5, 6):
        write_day(tmp_path, ANCHOR - timedelta(back), [record(str(back)), record(f"{back}x")])
    got = S.scan_lookback(spark, f"{tmp_path}/", SC.N_RUNNING, ANCHOR, COMPACT)
    assert {(r.t_IDs, r.snapshot_date) for r in got.collect()} == {
        (i + x, ANCHOR - timedelta(int(i))) for i in "025" for x in ("", "x")
    }
    assert got.first().t_comments == ["좋아요 ㅋㅋ", "b\nc"]


def test_anchor_is_required_and_may_stand_alone(spark, tmp_path):
    write_day(tmp_path, ANCHOR, [record("1")], DASHED)
    assert S.scan_lookback(spark, f"{tmp_path}/", SC.N_RUNNING, ANCHOR, DASHED).count() == 1
    with pytest.raises(AnalysisException):
        S.scan_lookback(spark, f"{tmp_path}/", SC.N_RUNNING, ANCHOR + timedelta(1), DASHED).count()


def test_id_types_and_columns_may_differ_between_days(spark, tmp_path):
    write_day(tmp_path, ANCHOR, [record(17)])
    write_day(tmp_path, ANCHOR - timedelta(1), [{"new": 1, "t_IDs": "17", "t_names": "a"}])
    write_day(tmp_path, ANCHOR - timedelta(2), [{"t_IDs": "18", "title": "renamed"}])
    got = {(r.t_IDs, r.t_names) for r in S.scan_lookback(spark, f"{tmp_path}/", SC.N_RUNNING, ANCHOR, COMPACT).collect()}
    assert got == {("17", "n17"), ("17", "a"), ("18", None)}


def test_broken_lines_keep_their_text(spark, tmp_path):
    (tmp_path / "20240310.json").write_text('{"t_IDs":"1","t_names":"a"}\n{"t_IDs": oops\n')
    days = S.scan_lookback(spark, f"{tmp_path}/", SC.N_FINISHED, ANCHOR, COMPACT, keep_corrupt=True)
    good, bad = S.split_corrupt(days)
    assert [r.t_IDs for r in good.collect()] == ["1"]
    assert [r[SC.CORRUPT] for r in bad.select("t_IDs", SC.CORRUPT).collect()] == ['{"t_IDs": oops']


def test_offset_reads_one_day(spark, tmp_path):
    write_day(tmp_path, ANCHOR - timedelta(50), [record("1")])
    write_day(tmp_path, ANCHOR, [record("2")])
    assert [r.t_IDs for r in S.scan_offset(spark, f"{tmp_path}/", SC.N_FINISHED, ANCHOR, COMPACT).collect()] == ["1"]


def test_table_lookback_prunes_partitions(spark, tmp_path):
    days = spark.range(10).select("id", F.date_sub(F.lit(ANCHOR), F.col("id").cast("int")).alias("snapshot_date"))
    days.write.partitionBy("snapshot_date").parquet(f"{tmp_path}/t")
    got = S.lookback(spark.read.parquet(f"{tmp_path}/t"), ANCHOR)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4, 5]
    assert len(got.inputFiles()) > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_union_days_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2, 3.0)], "s string, i int, extra double")
    assert sorted(map(tuple, S.union_days(a, b).select("i", "s", "extra").collect())) == [(1, "x", None), (2, "y", 3.0)]


def test_json_and_partitioned_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", ["a", 'q"uote'], "d1", "mon", ANCHOR), ("2", [], "d2", "tue", ANCHOR - timedelta(1)), ("3", None, "d1", "tue", ANCHOR)],
        "t_IDs string, t_comments array<string>, dataset string, weekday string, snapshot_date date",
    )
    K.write_json(df, f"{tmp_path}/json")
    back = spark.read.schema(df.schema).json(f"{tmp_path}/json")
    assert sorted(map(str, back.select(df.columns).collect())) == sorted(map(str, df.collect()))
    K.write_partitioned(df, f"{tmp_path}/parts")
    assert (tmp_path / "parts" / "dataset=d1" / "weekday=mon" / "snapshot_date=2024-03-10").is_dir()
    with pytest.raises(AnalysisException):
        K.write_json(df, f"{tmp_path}/json")


def test_crawled_csv_to_snapshot(spark, tmp_path):
    import csv

    names = SC.K_CSV_WEEKDAY.names
    lists = (["월", "화"], ["it's", 'say "x"', "both ' and \"", "tab\there", "\xa0"], ["첫째\n줄", "😀"])
    row = ["12", "/c/12", "", "a/b", "1.2m", "10k", "on", lists[0], "제목, 1", "w", "i", "p", "두\n줄 \"따옴표\"", lists[1], lists[2]]
    for name, header in (("new.csv", True), ("old.csv", False)):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            if header:
                out.writerow(names)
            out.writerow(row)
        got = K.read_weekday_csv(spark, f"{tmp_path}/{name}", header).collect()
        assert len(got) == 1
        assert (got[0].id, got[0].title, got[0].story_line) == ("12", "제목, 1", "두\n줄 \"따옴표\"")
        assert (got[0].day, got[0].key_words, got[0].best_comments) == lists
    completed = K.read_completed_csv(spark, _completed(tmp_path, names, row))
    both = K.union_shapes(K.read_weekday_csv(spark, f"{tmp_path}/new.csv"), completed)
    assert sorted((r.id, str(r.day)) for r in both.collect()) == [("12", "None"), ("12", "['월', '화']")]


def _completed(folder, names, row):
    import csv

    path = folder / "done.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow([n for n in names if n != "day"])
        out.writerow([v for n, v in zip(names, row) if n != "day"])
    return str(path)


def test_upsert_replaces_whole_items_and_is_idempotent(spark, tmp_path):
    old = spark.createDataFrame([("1", "a", ["mon"]), ("2", "b", ["tue"])], "t_id string, title string, weekdays array<string>")
    new = spark.createDataFrame([("2", "B", 1), ("2", "BB", 2), ("3", "c", 1)], "t_id string, title string, v int")
    order = [F.col("v").desc()]
    once = U.upsert(old, new, "t_id", order)
    want = {("1", "a", ("mon",)), ("2", "BB", None), ("3", "c", None)}
    shape = lambda df: {(r.t_id, r.title, tuple(r.weekdays) if r.weekdays else None) for r in df.collect()}
    assert shape(once) == want and once.count() == 3
    assert shape(U.upsert(once, new, "t_id", order)) == want
    base = f"{tmp_path}/items"
    U.publish(once, base, 1)
    assert shape(U.read_version(spark, base, 1)) == want
    with pytest.raises(AnalysisException):
        U.publish(once, base, 1)
    item = U.to_items(old, "t_id").where("t_id = '1'").first().item
    assert json.loads(item) == {"t_id": "1", "title": "a", "weekdays": ["mon"]}


def test_session_helpers(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    conf = object_store_conf("https://store.example")
    assert "spark.hadoop.fs.s3a.access.key" not in conf and len(object_store_conf("e", "a", "b")) == 4


def test_first_looks(spark, tmp_path):
    write_day(tmp_path, ANCHOR, [record("2"), record("1")])
    assert "t_comments" in S.infer_schema(spark, f"{tmp_path}/20240310.json").names
    days = S.scan_lookback(spark, f"{tmp_path}/", SC.N_RUNNING, ANCHOR, COMPACT)
    assert [r.t_IDs for r in S.preview(days, ["t_IDs"], 1).collect()] == ["1"]
    assert [tuple(r) for r in S.snapshot_counts(days).collect()] == [(ANCHOR, 2)]


def test_each_update_is_computed_once(spark):
    from pyspark.sql import functions as F

    from leafline.sources import upsert as U

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    existing = spark.range(50).select(F.col("id").alias("key"), F.lit(0).cast("long").alias("v"))
    updates = spark.range(100).select((F.col("id") % 40).alias("key"), counted(F.col("id")).alias("v"))
    got = {r.key: r.v for r in U.upsert(existing, updates, "key", [F.col("v").desc()]).collect()}
    assert got == {k: (k + 80 if k < 20 else k + 40) if k < 40 else 0 for k in range(50)}
    assert seen.value == 100


def test_broadcast_is_bounded_by_bytes(spark):
    from pyspark.sql import functions as F

    from leafline.session import broadcast_if_small

    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(wide)) and not hinted(broadcast_if_small(wide, max_bytes=5000))
    assert not hinted(broadcast_if_small(wide, max_rows=9))
    lists = spark.range(10).select(F.array_repeat(F.repeat(F.lit("x"), 100), 10).alias("t"))
    assert not hinted(broadcast_if_small(lists, max_bytes=5000))


@pytest.mark.parametrize("block,end", [(9, "\n"), (9, "\r\n"), (60, "\r\n"), (1 << 20, "\n")])
def test_csv_in_any_splits_equals_the_whole_file_reader(spark, tmp_path, block, end):
    rnd = random.Random(block)
    texts = ["", "plain", "two\nlines", 'quo"ted', "a,b", '"', '""', "\n\n", "tail\n", '"\n"', "한글\n줄", "x" * 90]
    for n in (0, 1, 40):
        with open(tmp_path / f"{n}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", "a", "b"])
            out.writerows([[f"{n}-{i}", rnd.choice(texts), rnd.choice(texts)] for i in range(n)])
    schema = StructType([StructField(c, StringType()) for c in ("id", "a", "b")])
    want = spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(str(tmp_path)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = K.read_csv(spark, str(tmp_path), schema).collect()
        blocks = K._csv_lines(spark, str(tmp_path)).select("file", "block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    key = lambda rows: sorted(map(str, rows))
    assert key(got) == key(want) and len(got) == 41 and (block > 100 or blocks > 6)


def test_csv_header_and_open_quotes(spark, tmp_path):
    schema = StructType([StructField(c, StringType()) for c in ("id", "a")])
    (tmp_path / "x.csv").write_text('id,a\n1,"never\nends\n2,b\n')
    assert [r.id for r in K.read_csv(spark, str(tmp_path), schema).collect()] == ["1"]
    (tmp_path / "x.csv").write_text("a,id\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        K.read_csv(spark, str(tmp_path), schema).collect()
