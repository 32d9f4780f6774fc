import collections
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafline.functions.text import clean_text, tokenize, word_counts
from leafline.operators import vectors as V


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def test_clean_keeps_latin_digits_and_syllables(spark):
    text = "ㅋㅋ 귀안들려도_괜찮아! café 😀 2nd\n"
    want = re.sub("[^A-Za-z0-9가-힣]", " ", text.replace("😀", " ")).strip()
    assert one(spark, clean_text(F.col("t")), t=text).split() == want.split()
    assert one(spark, clean_text(F.col("t")), t="a_b!c") == "a b c"
    assert one(spark, clean_text(F.col("t")), t="ㅋㅋ!") == ""


def test_tokenize_length_case_and_stop_words(spark):
    assert one(spark, tokenize(F.col("t")), t="I am in 서울 a AM") == ["am", "in", "서울", "AM"]
    assert one(spark, tokenize(F.col("t"), lower=True), t="AM Am") == ["am", "am"]
    assert one(spark, tokenize(F.col("t"), stop_words=["in"]), t="am in in") == ["am"]
    assert one(spark, tokenize(F.col("t"), min_length=1), t="a bc") == ["a", "bc"]


def test_tokenize_is_cleaning_and_splitting(spark):
    texts = ["été à Paris", "x", "", "a b  cc", "한글과english섞임 99", "-- --", "tail  "]
    df = spark.createDataFrame([(t,) for t in texts], ["t"])
    split = F.filter(F.split(clean_text(F.col("t")), r"\s+"), lambda w: F.length(w) > 1)
    assert df.where(tokenize(F.col("t")) != split).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "aa", "가", "z"]), max_size=12), min_size=1, max_size=8))
def test_word_counts_are_counts(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, w array<string>")
    got = {r.i: {x.term: x.n for x in r.b} for r in df.select("i", word_counts(F.col("w")).alias("b")).collect()}
    assert got == {i: dict(collections.Counter(d)) for i, d in enumerate(docs)}


def test_bag_of_empty_and_missing(spark):
    df = spark.createDataFrame([("a", 0, ""), ("a", 1, None), ("a", 2, "ww ww")], "t_id string, comment_pos int, comment string")
    assert [tuple(r) for r in V.bag_of_words(V.with_bag(df)).collect()] == [("a", 2, "ww", 2)]


def test_tokens_column_replaces_splitting(spark):
    row = ("a", 0, "ignored text", [None, "명사", None, "명사"])
    df = spark.createDataFrame([row], "t_id string, comment_pos int, comment string, tok array<string>")
    rows = V.bag_of_words(V.with_bag(df, tokens="tok")).collect()
    assert [tuple(r) for r in rows] == [("a", 0, "명사", 2)]


def test_vocabulary_cut_and_ties(spark):
    df = spark.createDataFrame([("a", 0, "bb cc bb"), ("b", 0, "cc dd"), ("c", 0, "")], "t_id string, comment_pos int, comment string")
    vocab = V.vocabulary(V.with_bag(df), max_terms=2).orderBy("term").collect()
    assert [(r.term, r.tf, r.df, r.n_docs) for r in vocab] == [("bb", 2, 1, 3), ("cc", 2, 2, 3)]
