import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from leafline.operators import ranking as R
from leafline.operators import records as Rec
from leafline.operators import threshold
from leafline.plans import recommend as P


def words_of(text):
    return [w for w in re.sub("[^A-Za-z0-9가-힣]", " ", text.lower()).split() if len(w) > 1]


def brute_hits(comments, review, exclude, max_terms=2000, first=1, last=20, fit_all=False):
    """TF-IDF and cosine over plain lists; [(t_id, pos, score)] of the hits."""
    kept = [c for c in comments if c[0] is not None and c[0] != exclude]
    corpus = [c for c in comments if c[0] is not None] if fit_all else kept
    tf, df = collections.Counter(), collections.Counter()
    for _, _, text in corpus:
        tf.update(words_of(text))
        df.update(set(words_of(text)))
    vocab = sorted(tf, key=lambda w: (-tf[w], w))[:max_terms]
    idf = {w: math.log((1 + len(corpus)) / (1 + df[w])) + 1 for w in vocab}

    def vector(text):
        raw = {w: n * idf[w] for w, n in collections.Counter(words_of(text)).items() if w in idf}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {w: v / norm for w, v in raw.items()}

    q = vector(review)
    scored = [(t, p, round(sum(q.get(w, 0) * v for w, v in vector(c).items()), 9), c) for t, p, c in kept]
    scored = sorted((s for s in scored if s[2] > 0), key=lambda s: (-s[2], s[0], s[1]))
    return scored[first : last + 1]


LETTERS = ["aa", "bb", "cc", "dd", "ee", "ff", "가나", "다라"]


def corpus(seed, n_titles=8, per_title=5):
    rnd = random.Random(seed)
    return [
        (f"N{t}", p, " ".join(rnd.choices(LETTERS, k=rnd.randint(0, 6))))
        for t in range(n_titles)
        for p in range(per_title)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "t_id string, comment_pos int, comment string")


def plain(df):
    return [(r.t_id, r.comment_pos, round(r.score, 6)) for r in df.orderBy("rank").collect()]


def near(got, want):
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == pytest.approx(w[2], abs=2e-6)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("max_terms", [3, 2000])
def test_hits_equal_brute_force(spark, seed, max_terms):
    rows = corpus(seed) + [(None, 0, "aa bb")]
    got = P.similar_comments(frame(spark, rows), "AA aa bb 가나 zz", "N3", max_terms=max_terms)
    near(plain(got), brute_hits(rows, "AA aa bb 가나 zz", "N3", max_terms))


def test_rows_alike_keep_their_number(spark):
    # the same title on three days: same position, same text
    rows = [("N1", 0, "aa bb")] * 3 + [("N1", 0, "aa cc"), ("N2", 0, "cc dd"), ("N2", 1, "ee")]
    got = P.similar_comments(frame(spark, rows), "aa bb", "N9", hits=10)
    near(plain(got), brute_hits(rows, "aa bb", "N9", last=10))
    reviews = spark.createDataFrame([("u", "N9", ["g"], "aa bb")], "user_id string, t_id string, fav_genres array<string>, review string")
    near(plain(P.similar_comments_batch(frame(spark, rows), reviews, hits=10)), brute_hits(rows, "aa bb", "N9", last=10))


def test_skip_top_and_equal_scores(spark):
    rows = [(f"N{i}", 0, "aa bb") for i in range(5)] + [("N9", 0, "cc")]
    got = P.similar_comments(frame(spark, rows), "aa bb", "N9", skip_top=0, hits=3)
    assert [r.t_id for r in got.orderBy("rank").collect()] == ["N0", "N1", "N2"]
    got = P.similar_comments(frame(spark, rows), "aa bb", "N9", hits=3)
    assert [r.t_id for r in got.orderBy("rank").collect()] == ["N1", "N2", "N3"]


def test_copy_of_the_review_ranks_first_with_score_one(spark):
    rows = corpus(5) + [("N77", 0, "aa ff 다라")]
    hit = P.similar_comments(frame(spark, rows), "aa ff 다라", "N0", skip_top=0, hits=1).first()
    assert hit.t_id == "N77" and hit.score == pytest.approx(1.0)
    scores = P.cosine_scores(frame(spark, rows), "aa ff 다라", "N0")
    assert scores.where("score > 1 + 1e-9 or score <= 0").count() == 0


def info(spark, rows):
    return spark.createDataFrame(rows, "t_id string, genre array<string>")


def test_boost_default_genre_and_top(spark):
    rows = [("N1", 0, "aa bb"), ("N2", 0, "aa bb cc"), ("N3", 0, "aa cc dd"), ("N4", 0, "zz")]
    titles = info(spark, [("N1", ["x"]), ("N2", ["스토리"]), ("N3", ["y"]), ("N4", None)])
    kw = dict(skip_top=0)
    plain_best = P.recommend_titles(titles, frame(spark, rows), "N9", "none such", "aa bb", **kw).collect()
    assert [r.t_id for r in plain_best] == ["N1", "N2", "N3"]
    boosted = P.recommend_titles(titles, frame(spark, rows), "N9", None, "aa bb", **kw).collect()
    base = {r.t_id: r.score for r in plain_best}
    assert {r.t_id: r.score for r in boosted}["N2"] == pytest.approx(base["N2"] * 1.3, abs=1e-8)
    listed = P.recommend_titles(titles, frame(spark, rows), "N9", ["q", "y"], "aa bb", titles=1, **kw).collect()
    assert len(listed) == 1


def test_nothing_in_common_is_an_empty_result(spark):
    titles = info(spark, [("N1", ["x"])])
    out = P.recommend_titles(titles, frame(spark, [("N1", 0, "aa bb")]), "N9", "x", "qq ww")
    assert out.columns == ["user_t_id", "rank", "t_id", "score"] and out.count() == 0
    assert P.recommend_titles(titles, frame(spark, []), "N9", "x", "qq").count() == 0


def test_comments_from_arrays_with_days_repeated(spark):
    tab = spark.createDataFrame([("N1", ["aa bb", None, "cc"]), ("N1", ["aa bb"]), ("N2", []), ("N3", None)], "t_id string, best_comments array<string>")
    rows = Rec.explode_comments(tab)
    assert sorted((r.t_id, r.comment_pos, r.comment) for r in rows.collect()) == [("N1", 0, "aa bb"), ("N1", 0, "aa bb"), ("N1", 2, "cc")]


REVIEWS = "user_id string, t_id string, fav_genres array<string>, review string"


def test_batch_of_one_is_the_single_form(spark):
    rows = corpus(3)
    titles = info(spark, [(f"N{i}", ["x"] if i % 2 else ["y"]) for i in range(8)])
    comments = frame(spark, rows)
    single = P.recommend_titles(titles, comments, "N2", ["x"], "aa bb ee")
    reviews = spark.createDataFrame([("u1", "N2", ["x"], "aa bb ee")], REVIEWS)
    key = lambda df: sorted((r.rank, r.t_id, round(r.score, 6)) for r in df.collect())
    assert key(single) == key(P.recommend_batch(titles, comments, reviews)) != []
    assert key(single) == key(P.recommend_batch(titles, comments, reviews, fit_on=comments.where(F.col("t_id") != "N2")))


def asked(spark):
    rnd = random.Random(9)
    revs = [(f"u{i}", None if i == 0 else f"N{i % 8}", None, " ".join(rnd.choices(LETTERS, k=5))) for i in range(9)]
    return [*revs, ("u9", "N77", None, "aa dd"), ("u9", "N1", None, "none known"), ("u9", "N2", None, None), ("u9", "N3", None, "")]


@pytest.mark.parametrize("broadcast_rows,shared", [(500_000, False), (12, True), (2, False)])
def test_batch_equals_brute_force_in_any_number_of_rounds(spark, broadcast_rows, shared):
    rows, revs = corpus(4) + [(None, 0, "aa")], asked(spark)
    comments = frame(spark, rows)
    got = P.similar_comments_batch(
        comments, spark.createDataFrame(revs, REVIEWS), fit_on=comments.where("t_id is not null") if shared else None,
        broadcast_rows=broadcast_rows
    ).collect()
    for user, own, _, text in revs:
        mine = sorted((r for r in got if (r.user_id, r.user_t_id) == (user, own)), key=lambda r: r["rank"])
        near([(r.t_id, r.comment_pos, r.score) for r in mine], brute_hits(rows, text or "", own, fit_all=shared))


@pytest.mark.parametrize("max_terms", [1, 4])
def test_left_out_titles_change_the_vocabulary(spark, max_terms):
    """Title N0 alone says most words, so other words come in when it is left out,
    from beyond twice the number of terms."""
    rows = corpus(8) + [("N0", 10 + i, " ".join(LETTERS + [f"z{i}", "zz yy xx ww vv"] * 3)) for i in range(30)]
    rows += [("N5", 9, "z1 z1 zz qq"), ("N6", 9, "qq aa bb")]
    revs = [("u", "N0", None, "qq aa zz 다라"), ("u", "N5", None, "zz qq aa"), ("v", None, None, "zz yy cc"), ("v", "N6", None, "zz z1")]
    got = P.similar_comments_batch(frame(spark, rows), spark.createDataFrame(revs, REVIEWS), max_terms=max_terms).collect()
    assert got
    for user, own, _, text in revs:
        mine = sorted((r for r in got if (r.user_id, r.user_t_id) == (user, own)), key=lambda r: r["rank"])
        near([(r.t_id, r.comment_pos, r.score) for r in mine], brute_hits(rows, text, own, max_terms))


def test_few_pairs_are_scored(spark, monkeypatch):
    """Of comments that nearly all share a word with each review."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    share = [1 / (i + 1) for i in range(400)]
    rows = [(f"N{i % 40}", i // 40, " ".join(rnd.choices(words, share, k=rnd.randint(3, 14)))) for i in range(2000)]
    revs = [(f"u{i}", f"N{i}", None, " ".join(rnd.choices(words, share, k=8))) for i in range(30)]
    summed, pairs = [], []
    exact, reach = threshold.exact_scores, threshold.within_reach
    monkeypatch.setattr(threshold, "exact_scores", lambda p, dot: exact(pairs.append(p) or p, dot))
    monkeypatch.setattr(threshold, "within_reach", lambda *a: summed.append(reach(*a)) or summed[-1])
    got = P.similar_comments_batch(frame(spark, rows), spark.createDataFrame(revs, REVIEWS)).collect()
    scored = [p.count() for p in pairs]
    alike = sum(bool(set(words_of(c)) & set(words_of(r))) for _, _, c in rows for *_, r in revs)
    assert len(scored) == 2 and 0 < sum(scored) < 0.1 * len(rows) * len(revs) < alike / 5, (scored, alike)
    assert summed[0].count() < 0.5 * alike
    for user, own, _, text in revs:
        mine = sorted((r for r in got if r.user_id == user), key=lambda r: r["rank"])
        near([(r.t_id, r.comment_pos, r.score) for r in mine], brute_hits(rows, text, own))


def test_no_comments_or_reviews(spark):
    reviews = spark.createDataFrame([("u", "N1", None, "aa bb")], REVIEWS)
    none = P.similar_comments_batch(frame(spark, []), reviews)
    assert none.count() == 0 and "comment_key" in none.columns
    assert P.similar_comments_batch(frame(spark, corpus(1)), reviews.limit(0)).count() == 0
    assert P.similar_comments_batch(frame(spark, [("N1", 0, "aa bb")]), reviews).count() == 0


def test_favourites(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, [None])], "i int, g array<string>")
    got = {r.i: r.f for r in df.select("i", R.favourites(F.col("g")).alias("f")).collect()}
    assert got == {1: ["a"], 2: ["스토리"], 3: ["스토리"], 4: ["스토리"]}


def test_offset_and_dedup(spark):
    df = spark.range(10).select(F.col("id").alias("rank"), (F.col("id") % 3).alias("k"))
    assert [r["rank"] for r in R.offset_limit(df, [F.col("rank").desc()], 1, 2).collect()] == [8, 7]
    assert sorted(tuple(r) for r in R.dedup_keep_best(df, ["k"]).collect()) == [(0, 0), (1, 1), (2, 2)]


@pytest.mark.parametrize("reviewed", ["N3", "N99", None])
def test_stored_statistics_give_the_same_model(spark, reviewed):
    comments = frame(spark, corpus(6) + [(None, 0, "aa bb zz"), ("N3", 9, "only here"), ("N3", 10, "")])
    stats = P.corpus_stats(comments)
    for max_terms in (3, 2000):
        once = P.similar_comments(comments, "aa bb 가나 only", reviewed, max_terms=max_terms)
        again = P.similar_comments(comments, "aa bb 가나 only", reviewed, max_terms=max_terms, stats=stats)
        near(plain(again), plain(once))
    assert once.count() > 0


def test_two_reviews_of_one_reader_are_apart(spark):
    rows = corpus(7)
    titles = info(spark, [(f"N{i}", ["x"]) for i in range(8)])
    revs = [("u", "N1", ["x"], "aa bb ee"), ("u", "N5", ["y"], "ff 가나 cc"), ("v", "N1", None, "dd dd")]
    both = P.recommend_batch(titles, frame(spark, rows), spark.createDataFrame(revs, REVIEWS)).collect()
    for one in revs:
        alone = P.recommend_batch(titles, frame(spark, rows), spark.createDataFrame([one], REVIEWS)).collect()
        mine = [(r["rank"], r.t_id, r.score) for r in both if (r.user_id, r.user_t_id) == one[:2]]
        assert sorted(mine) == sorted((r["rank"], r.t_id, r.score) for r in alone) and len({t for _, t, _ in mine}) == len(mine)
        assert all(s <= 1.3 + 1e-9 for *_, s in mine)
