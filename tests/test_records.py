from datetime import date, timedelta

from pyspark.sql import functions as F

from leafline import schemas as SC
from leafline.functions import fields as X
from leafline.functions import urls as U
from leafline.operators import records as R
from leafline.plans import catalog as C

D = date(2024, 3, 10)


def col(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def test_keys_and_authors(spark):
    df = spark.createDataFrame([("1", "a", "a"), (None, "a", "b"), ("3", None, "b"), ("4", "a", None)], "id string, w string, i string")
    got = df.select(X.title_key("K", F.col("id")), X.merged_author(F.col("w"), F.col("i"))).collect()
    assert [tuple(r) for r in got] == [("K1", "a"), (None, "a/b"), ("K3", None), ("K4", None)]
    assert [r.t_id for r in R.key_prefix_sql(df, "K", "id").collect()] == ["K1", None, "K3", "K4"]


def test_field_functions(spark):
    x = F.col("x")
    assert col(spark, " \t가 나\n ", X.strip_ws(x)) == "가 나"
    assert col(spark, "", X.default_value(x, "d")) == "d" and col(spark, None, X.default_value(x, "d")) == "d"
    assert col(spark, ["a\nb", None], X.flatten_newlines(x), "array<string>") == ["a b", None]
    assert [col(spark, v, X.at_least(x, 9.9)) for v in ("9.90", "9.89", "n/a", None, "10")] == [True, False, False, False, True]
    assert col(spark, "a/b", X.split_slash(x)) == ["a", "b"]
    assert col(spark, "a, b,c", X.split_comma(x)) == ["a", "b,c"]
    assert col(spark, "A / B", X.split_authors(x)) == ["A", "B"]


def test_link_functions_never_raise(spark):
    x = F.col("x")
    url = "/list?titleId=7481&weekday=wed#top"
    assert col(spark, url, U.query_value(x, "titleId")) == "7481"
    assert col(spark, url, U.first_query_value(x)) == "7481"
    assert col(spark, url, U.link_param(x, 1)) == "wed#top"
    for bad in ("", "no query", "%%%", None):
        for f in (U.query_value(x, "a"), U.first_query_value(x), U.link_param(x, 1), U.tail_id(x)):
            assert col(spark, bad, f) is None
    assert col(spark, "https://h/content/t/2345", U.tail_id(x)) == 2345
    assert col(spark, "/a", U.absolute_link("https://h/", x)) == "https://h/a"
    assert col(spark, "https://o/a", U.absolute_link("https://h", x)) == "https://o/a"


def n_rows(spark):
    def rec(i, day, name, comments):
        return (i, ["mon"], name, "A / B", "x, y", "12", "sum", "/t", "/u", comments, day)

    rows = [
        rec("1", D, "new", ["c1"]), rec("1", D - timedelta(2), "old", ["c0"]), rec("2", D - timedelta(5), "edge", []),
        rec("3", D - timedelta(6), "too old", ["c"]), rec(None, D, "no id", None),
    ]
    return spark.createDataFrame(rows, SC.dated(SC.N_RUNNING))


def k_rows(spark):
    cols = [f for f in SC.dated(SC.K_JSON).names]
    base = dict.fromkeys(cols)
    rows = [
        {**base, "id": "1", "title": "k", "genre": "g/h", "story_writer": "w", "illustrator": "w", "day": ["월"],
         "best_comments": ["kc"], "key_words": ["kw"], "snapshot_date": D},
        {**base, "id": "1", "title": "k old", "genre": "g", "story_writer": "w", "illustrator": "i", "best_comments": ["k0"],
         "snapshot_date": D - timedelta(1)},
    ]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SC.dated(SC.K_JSON))


def test_title_info_keeps_the_newest_row_of_each_key(spark):
    info = C.title_info(n_rows(spark), k_rows(spark), D)
    assert info.columns == SC.TITLE_INFO_COLUMNS
    assert info.schema.simpleString() == SC.TITLE_INFO.simpleString()
    got = {r.t_id: r for r in info.collect()}
    assert {k: v.title for k, v in got.items()} == {"N1": "new", "N2": "edge", "K1": "k"}  # a row without a key is no title
    assert got["K1"].genre == ["g", "h"] and got["K1"].author == "w" and got["K1"].site == 0
    assert got["N1"].genre == ["x", "y"] and got["N1"].author == "A / B" and got["N1"].site == 1


def test_a_day_outside_the_lookback_changes_nothing(spark):
    n, k = n_rows(spark), k_rows(spark)
    more = n.unionByName(n.withColumn("snapshot_date", F.lit(D - timedelta(30))).withColumn("t_IDs", F.lit("99")))
    key = lambda df: sorted(str(r) for r in df.collect())
    assert key(C.title_info(more, k, D)) == key(C.title_info(n, k, D))
    assert key(C.comments(more, k, D)) == key(C.comments(n, k, D))


def test_anchors_may_differ_by_site(spark):
    info = C.title_info(n_rows(spark), k_rows(spark), D - timedelta(1), anchor_k=D - timedelta(1), back=0)
    assert [(r.t_id, r.title) for r in info.collect()] == [("K1", "k old")]


def test_comments_of_all_days_or_the_latest(spark):
    every = C.comments(n_rows(spark), k_rows(spark), D)
    assert sorted((r.t_id, r.best_comments) for r in every.where("t_id is not null").collect()) == [
        ("K1", ["k0"]), ("K1", ["kc"]), ("N1", ["c0"]), ("N1", ["c1"]), ("N2", []),
    ]
    latest = C.comments(n_rows(spark), k_rows(spark), D, latest=True).where("t_id is not null")
    assert sorted((r.t_id, r.best_comments) for r in latest.collect()) == [("K1", ["kc"]), ("N1", ["c1"]), ("N2", [])]
    assert sorted(r.t_id for r in R.nonempty_comments(every).where("t_id is not null").collect()) == ["K1", "K1", "N1", "N1"]
    assert C.keyword_reviews(k_rows(spark)).columns == ["t_id", "best_comments", "key_words"]


def test_finished_info(spark):
    raw = n_rows(spark).drop("t_weekdays", "t_comments")
    info = C.finished_info(raw, D + timedelta(50))
    assert info.columns == SC.FINISHED_INFO_COLUMNS
    assert {r.t_id for r in info.collect()} == {"N1"}  # a row without a key is no title


def test_split_authors_on_request(spark):
    assert R.prepare_n(n_rows(spark), split_authors=True).first().t_auth == ["A", "B"]
