"""What the physical plans must and must not hold."""

import re

import pytest

import suite

suite.load_all()
SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(suite.CASES) - {"title_topics"}))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(suite.CASES[name][0](spark, SF_DIR))
    assert not re.search(r"EvalPython|MapInPandas|InPandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_pairs_of_the_batch_are_never_shuffled(spark):
    text = plan(suite.CASES["ranked_hits"][0](spark, SF_DIR))
    # stored comments by comment, the same exchange on both sides of a join, and hits by
    # review (after the cut to 21 per review)
    lines = text.splitlines()
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    keys = [re.sub(r"#\d+L?", "", re.search(r"hashpartitioning\((.*?), \d+\)", lines[i])[1]) for i in at]
    assert sorted(keys) == ["cid", "cid", "user_id, user_t_id"]
    for i, key in zip(at, keys):
        if key == "cid":
            under = next(k for k in range(i + 1, len(lines)) if not re.search(r"[-+] (Project|Filter|ColumnarToRow)\b", lines[k]))
            assert "FileScan" in lines[under] and "comment-rows" in lines[under]
    assert "WindowGroupLimit" in text and "Partial" in text


def test_single_review_shuffles_no_comment(spark):
    text = plan(suite.CASES["similar_comments"][0](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in text
    assert text.count("TakeOrderedAndProject") == 1


def test_newest_row_is_cut_before_the_shuffle(spark):
    text = plan(suite.CASES["latest_per_key"][0](spark, SF_DIR))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_lookback_reaches_the_scan(spark):
    text = plan(suite.CASES["snapshot_lookback"][0](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-25" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
