import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.operators import title_words as T
from leafline.plans import topics as P

THEMES = [["sword", "dragon", "castle"], ["kiss", "heart", "date"], ["goal", "match", "team"]]


def planted(spark, titles=3, per_title=40):
    rnd = np.random.RandomState(3)
    rows = []
    for t in range(titles):
        for p in range(per_title):
            theme = THEMES[t] if p % 4 else THEMES[(t + 1) % 3]
            rows.append((f"N{t}", p, " ".join([*rnd.choice(theme, 2), f"x{t}{p}"])))
    rows += [("N8", 0, "lonely comment"), (None, 0, "no title")]
    return spark.createDataFrame(rows, "t_id string, comment_pos int, comment string")


def check(got, spark):
    assert set(got) == {"N0", "N1", "N2"}
    docs = T.title_documents(planted(spark))
    own = {(r.t_id, r.term) for r in T.title_terms(docs).collect()}
    for t_id, words in got.items():
        assert 1 <= len(words) <= 3 and len(set(words)) == len(words)
        assert all((t_id, w) in own for w in words)


def test_shared_model_finds_themes_and_gives_each_title_its_own_words(spark):
    got = {r.t_id: r.t_topics for r in P.title_topics(planted(spark), num_topics=3).collect()}
    check(got, spark)
    themes = set(sum(THEMES, []))
    assert sum(w in themes for ws in got.values() for w in ws) >= 5
    assert got == {r.t_id: r.t_topics for r in P.title_topics(planted(spark), num_topics=3).collect()}


def test_a_title_of_rare_words_only_has_topics(spark):
    rare = spark.createDataFrame([("N7", p, f"once{p} only{p}") for p in range(4)], "t_id string, comment_pos int, comment string")
    got = {r.t_id: r.t_topics for r in P.title_topics(planted(spark).unionByName(rare), iterations=2).collect()}
    assert set(got) == {"N0", "N1", "N2", "N7"} and 1 <= len(got["N7"]) <= 3
    assert all(w.startswith(("once", "only")) for w in got["N7"])


def kept_bags(spark, rows):
    return spark.createDataFrame(rows, "t_id string, bag array<struct<term: string, n: bigint>>")


def by_hand(bags, k, iterations, seed):
    """The same model in plain Python, one start, word by word."""
    def start(w, i):
        return -math.log((xxhash_of[w, i] % P.PARTS + 1) / (P.PARTS + 1))

    words = sorted({w for bag in bags for w, _ in bag})
    xxhash_of = by_hand.hashes
    weight = {w: [start(w, i) for i in range(k)] for w in words}
    total = [float(len(words))] * k
    for step in range(iterations + 1):
        shares, sums = [], {w: [0.0] * k for w in words}
        p = {w: [(weight[w][i] + P.BETA) / (total[i] + P.BETA * len(words)) for i in range(k)] for w in words}
        for bag in bags:
            share = [1 / k] * k
            for _ in range(P.INNER):
                new, parts = [P.ALPHA] * k, []
                for w, n in bag:
                    part = [share[i] * p[w][i] for i in range(k)]
                    part = [x / sum(part) for x in part]
                    parts.append((w, n, part))
                    new = [new[i] + n * part[i] for i in range(k)]
                share = [x / sum(new) for x in new]
            for w, n, part in parts:
                sums[w] = [sums[w][i] + n * part[i] for i in range(k)]
            shares.append(share)
        if step < iterations:
            weight = sums
            total = [sum(s[i] for s in sums.values()) for i in range(k)]
    return weight, shares


def test_weights_and_shares_are_those_of_the_model_by_hand(spark):
    """Equal bags, one of them in another title, count as often as they occur."""
    bags = [[("aa", 2), ("bb", 1)], [("aa", 1), ("cc", 3)], [("dd", 1), ("ee", 2), ("bb", 1)], [("aa", 2), ("bb", 1)], [("ff", 1)]]
    kept = kept_bags(spark, [(f"N{i % 2}", bag) for i, bag in enumerate(bags)])
    words = sorted({w for bag in bags for w, _ in bag})
    rows = spark.createDataFrame([(w, i) for w in words for i in range(2)], "term string, i int")
    hashed = rows.selectExpr("term", "i", "xxhash64(term) AS w").selectExpr("term", "i", "w", "xxhash64(w, 7, i) AS h").collect()
    by_hand.hashes = {(r.term, r.i): r.h for r in hashed}
    want_weights, want_shares = by_hand(bags, 2, 3, 7)
    weights, shares = P.fit(kept, 2, 3, 7, starts=1)
    got = {r.w: r.weights for r in weights.collect()}
    for r in hashed:
        assert got[r.w] == pytest.approx(want_weights[r.term], abs=1e-4)
    got = kept.select("bag", *P.bag_key()).join(shares, [*P.BAG_KEY]).collect()
    assert shares.count() == 4 and len(got) == 5
    for r in got:
        assert r.share == pytest.approx(want_shares[bags.index([tuple(x) for x in r.bag])], abs=1e-4)


def colliding_pairs(spark, n):
    """Pairs of words with the same hash modulo 4,096."""
    rows = spark.range(40_000).selectExpr("concat('w', id) AS term").selectExpr("term", "pmod(xxhash64(term), 4096) AS b")
    pairs = rows.groupBy("b").agg(F.sort_array(F.collect_list("term")).alias("t")).orderBy("b").limit(n)
    return [r.t[:2] for r in pairs.collect()]


def test_themes_whose_words_share_a_hash_bucket_are_told_apart(spark):
    """Each word of one theme has a twin in the other that a table of 4,096
    buckets could not tell from it."""
    pairs = colliding_pairs(spark, 4)
    themes = [[a for a, _ in pairs], [b for _, b in pairs]]
    rnd = np.random.RandomState(5)
    rows = [(f"N{t}", [(str(w), 1) for w in rnd.choice(themes[t], 3, replace=False)]) for p in range(40) for t in (0, 1)]
    weights, shares = P.fit(kept_bags(spark, rows), 2, starts=4)
    terms = spark.createDataFrame([(w, t) for t in (0, 1) for w in themes[t]], "term string, theme int")
    found = terms.withColumn("w", F.xxhash64("term")).join(weights, "w").collect()
    top = {(r.theme, int(np.argmax(r.weights))) for r in found}
    assert len(found) == 8 and len(top) == 2 and len({k for _, k in top}) == 2
    assert all(max(r.weights) > 0.9 * sum(r.weights) for r in found)


def test_the_number_of_blocks_changes_nothing(spark, monkeypatch):
    rows = [(r.t_id, r.bag) for r in T.title_documents(planted(spark)).collect()]
    kept = kept_bags(spark, rows)
    want = {r.w: r.weights for r in P.fit(kept, 3, 4, starts=2)[0].collect()}
    monkeypatch.setattr(P, "SMALL_BLOCK", 16)
    got = {r.w: r.weights for r in P.fit(kept, 3, 4, starts=2)[0].collect()}
    assert set(got) == set(want) and all(got[w] == pytest.approx(want[w], abs=1e-3) for w in want)


def test_no_title_has_words_of_another_topic_only(spark):
    """A rare word takes nothing from a frequent one."""
    rows = [("N1", p, f"frequent rare{p} other{p % 3}") for p in range(6)] + [("N1", 9 + p, f"quite different{p}") for p in range(6)]
    comments = spark.createDataFrame(rows, "t_id string, comment_pos int, comment string")
    got = {r.t_id: r.t_topics for r in P.title_topics(comments, num_topics=2, iterations=4).collect()}
    assert got["N1"] and set(got["N1"]) <= {"frequent", "quite"}


def test_no_words_at_all(spark):
    lonely = spark.createDataFrame([("N1", 0, "one comment")], "t_id string, comment_pos int, comment string")
    assert P.title_topics(lonely).count() == 0
    docs = T.title_documents(lonely)
    assert [r.t_id for r in T.skipped_titles(docs, T.title_terms(docs)).collect()] == ["N1"]


def test_document_frequency_bounds(spark):
    rows = [("N1", 0, "aa bb"), ("N1", 1, "aa cc"), ("N1", 2, "aa bb"), ("N1", 3, "aa bb dd"), ("N1", 9, "aa cc")]
    docs = T.title_documents(spark.createDataFrame(rows, "t_id string, comment_pos int, comment string"))
    # repeated comments count once: 3 documents, so at most floor(2.1) = 2 of them
    got = {r.term: (r.df, r.n_docs) for r in T.title_terms(docs).collect()}
    assert got == {"bb": (2, 3), "cc": (1, 3), "dd": (1, 3)}


def test_bags_name_their_words_by_place_and_steps_change_nothing(spark, monkeypatch):
    kept = kept_bags(spark, [(r.t_id, r.bag) for r in T.title_documents(planted(spark)).collect()])
    monkeypatch.setattr(P, "SMALL_BLOCK", 64)
    bags, needs = P._bags(kept)
    words = {}
    for r in needs.orderBy("w").collect():
        words.setdefault(r.block, []).append(r.w)
    got = {(r.d1, r.d2): ([words[r.block][i] for i in r.at], r.n) for r in bags.collect()}
    want = kept.selectExpr("bag", "transform(bag, x -> xxhash64(x.term)) AS w").select("bag", "w", *P.bag_key()).collect()
    assert len(words) > 1 and got == {(r.d1, r.d2): (r.w, [x.n for x in r.bag]) for r in want}
    weights = [{r.w: r.weights for r in P.fit(kept, 3, 4, starts=2)[0].collect()}]
    monkeypatch.setattr(P, "STEP_WORDS", 2)
    weights.append({r.w: r.weights for r in P.fit(kept, 3, 4, starts=2)[0].collect()})
    assert weights[0] == weights[1]
