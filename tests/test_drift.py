"""Days whose records change shape."""

import json
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException

from leafline.functions.dates import COMPACT
from leafline.schemas import _table
from leafline.sources import drift as D

ANCHOR = date(2024, 3, 10)
SCHEMA = _table("t_IDs", "t_names", "t_comments[]")


def write(folder, back, *lines):
    day = ANCHOR - timedelta(back)
    (folder / f"{day.strftime(COMPACT)}.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines), encoding="utf-8")


def scan(spark, folder, **more):
    return D.scan_drifting(spark, f"{folder}/", SCHEMA, ANCHOR, COMPACT, **more)


def rec(i, name="n", comments=("a", "b"), **more):
    return {"t_IDs": i, "t_names": name, "t_comments": list(comments), **more}


def test_ids_as_numbers_on_one_day_or_in_one_record(spark, tmp_path):
    write(tmp_path, 0, [rec("0012"), rec("x")])
    write(tmp_path, 1, [rec(12), rec(9007199254740993)])
    write(tmp_path, 3, rec(1), rec("2"), rec(True), rec(None, None))
    days = scan(spark, tmp_path)
    got = {(r.t_IDs, r.snapshot_date) for r in days.rows.collect()}
    assert got == {
        ("0012", ANCHOR), ("x", ANCHOR), ("12", ANCHOR - timedelta(1)), ("9007199254740993", ANCHOR - timedelta(1)),
        *[(x, ANCHOR - timedelta(3)) for x in ("1", "2", "true", None)],
    }
    assert days.rejects.count() == 0
    kinds = {(str(r.snapshot_date), r.column): [tuple(k) for k in r.kinds] for r in days.report.collect()}
    assert dict(kinds["2024-03-07", "t_IDs"]) == {"BIGINT": 1, "STRING": 1, "BOOLEAN": 1, "VOID": 1}


def test_a_renamed_column_is_read_by_its_alias_or_its_day_is_rejected(spark, tmp_path):
    write(tmp_path, 0, [rec("1"), rec("2")])
    write(tmp_path, 1, [{"t_IDs": "3", "title": "three", "t_comments": []}, {"t_IDs": "4", "title": "four", "t_comments": None}])
    days = scan(spark, tmp_path)
    assert {r.t_IDs for r in days.rows.collect()} == {"1", "2"}
    assert [(r.reason, json.loads(r.record)["t_IDs"]) for r in days.rejects.orderBy("record").collect()] == [
        ("missing t_names; unknown title", "3"), ("missing t_names; unknown title", "4")
    ]
    days = scan(spark, tmp_path, aliases={"t_names": ["title"]})
    assert {(r.t_IDs, r.t_names) for r in days.rows.collect()} == {("1", "n"), ("2", "n"), ("3", "three"), ("4", "four")}
    assert days.rejects.count() == 0


def test_more_columns_and_fewer_columns_are_no_renaming(spark, tmp_path):
    write(tmp_path, 0, [rec("1", extra={"a": 1})])
    write(tmp_path, 2, [{"t_IDs": "2", "t_names": "two"}])
    days = scan(spark, tmp_path)
    assert {(r.t_IDs, None if r.t_comments is None else tuple(r.t_comments)) for r in days.rows.collect()} == {("1", ("a", "b")), ("2", None)}
    assert [r.name for r in days.report.where("column IS NULL").collect()] == ["extra"] and days.rejects.count() == 0


def test_what_does_not_fit_rejects_its_record_only(spark, tmp_path):
    write(
        tmp_path, 0, rec("1", comments=["a", 2, None, 1.50]), rec("2", name=["list"]), rec({"id": 3}), {**rec("4"), "t_comments": "text"},
        rec("5", comments=["a", ["b"]]), '{"t_IDs": "6", ', "", "7", [rec("8"), 9],
    )
    days = scan(spark, tmp_path)
    assert {(r.t_IDs, tuple(r.t_comments)) for r in days.rows.collect()} == {("1", ("a", "2", None, "1.5")), ("8", ("a", "b"))}
    reasons = sorted(r.reason for r in days.rejects.collect())
    assert reasons == sorted([
        "t_names is ARRAY<STRING>", "t_IDs is OBJECT<id: BIGINT>", "t_comments is STRING", "t_comments is ARRAY<VARIANT>",
        "no record", "no record", "no record",
    ])


def test_the_anchor_must_exist_and_an_empty_day_has_no_rows(spark, tmp_path):
    write(tmp_path, 1, [rec("1")])
    with pytest.raises(AnalysisException):
        scan(spark, tmp_path)
    write(tmp_path, 0, "")
    days = scan(spark, tmp_path, back=0)
    assert days.rows.count() == days.rejects.count() == days.report.count() == 0
    assert days.rows.columns == ["t_IDs", "t_names", "t_comments", "snapshot_date"]
