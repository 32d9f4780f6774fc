import random
from collections import Counter

import numpy as np

from leafline.llm import toxicity as T
from tests.llm.helpers import ALL, ODD, empty, frame, ids


def all_maximal(scores):
    """Every maximal segment by its definition: all proper subsegments score less,
    and no longer segment has that property; found by recursion on the best one."""
    def best(a, z):
        top, at = 0.0, None
        for i in range(a, z):
            s = 0.0
            for j in range(i, z):
                s += scores[j]
                if s > top + 1e-12 or (at and abs(s - top) < 1e-12 and j - i < at[1] - at[0]):
                    top, at = s, (i, j)
        return top, at

    def go(a, z):
        top, at = best(a, z)
        return [] if at is None else [*go(a, at[0]), (*at, top), *go(at[1] + 1, z)]

    return go(0, len(scores))


def test_segments_by_definition():
    rnd = random.Random(2)
    for _ in range(300):
        s = np.array([rnd.choice([-3, -2, -1, 1, 2, 5]) + rnd.random() * 0.01 for _ in range(rnd.randrange(0, 14))])
        got, want = T.segments(s), all_maximal(s)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def planted(spark, n=600):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rnd.randrange(200)}" for _ in range(rnd.randrange(10, 120))]
        bad = i % 5 == 0
        if bad:
            for _ in range(rnd.randrange(2, 7)):
                w.insert(rnd.randrange(len(w)), rnd.choice(["Vile", "ROTTEN!!", "foul###", "\"nasty.\""]))
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, 1, int(bad)))
    return frame(spark, rows), spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (99999, 0, 1)], "doc_id long, quality int, toxic int")


def test_toxic_texts_are_found(spark):
    docs, labels = planted(spark)
    model = T.fit(docs.where("doc_id % 3 <> 1"), labels)
    assert {"vile", "rotten", "foul", "nasty"} <= set(model.words)
    got = {r.doc_id: r for r in T.score_documents(docs.where("doc_id % 3 = 1"), model).collect()}
    assert len(got) == 200
    assert sum((r.score >= 0.7) == (i % 5 == 0) for i, r in got.items()) >= 196
    text = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    for i, r in got.items():
        for p in r.passages:
            assert text[i][p.first].strip('#!."') in model.words and text[i][p.last].strip('#!."') in model.words and p.score > 0


def test_odd_rows(spark):
    docs, labels = planted(spark, 100)
    model = T.fit(docs, labels)
    rows = T.score_documents(frame(spark, ODD), model).collect()
    assert ids(rows) == ALL and all(0 <= r.score <= 1 for r in rows)
    least = min(r.score for r in rows)
    assert all(r.score == least and r.passages == [] for r in rows if r.doc_id in (3, 4, 5))
    assert T.score_documents(empty(spark), model).count() == 0


def test_one_kind_of_label_or_none(spark):
    docs, labels = planted(spark, 30)
    for kept in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        rows = T.score_documents(docs, T.fit(docs, kept)).collect()
        assert len({r.score for r in rows}) == 1 and len(rows) == 30
    assert T.fit(empty(spark), labels).words == []


def test_repeated_labels_and_order_of_rows(spark):
    docs, labels = planted(spark, 200)
    a = T.fit(docs, labels)
    b = T.fit(docs.repartition(5), labels.unionByName(labels).repartition(3))
    assert Counter(a.words) == Counter(b.words) and abs(a.slope - b.slope) < 1e-6
