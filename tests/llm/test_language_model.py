import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafline.llm import gru
from leafline.llm import language_model as LM
from tests.llm.helpers import ALL, ODD, empty, frame, ids, words

SMALL = gru.Shape(head=128, tail=8, hidden=12)


def corpus(n=240):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        lang = "ab"[i % 2]
        rows.append((i, " ".join(f"{lang}{min(rnd.randrange(400), rnd.randrange(400))}" for _ in range(rnd.randrange(5, 90))), lang, "s"))
    return rows


def test_base_score_and_counts(spark, monkeypatch):
    monkeypatch.setattr(LM, "COUNTED", 150)  # most words take the join
    train, more = corpus()[:200], corpus()[200:]
    model, counts = LM.fit(frame(spark, train), shape=SMALL)
    test = more + ODD + [(77, "unseen a1 words a1", None, None)]
    got = LM.score_documents(frame(spark, test), model, counts).collect()
    c = Counter(w for r in train for w in [*words(r[1]), "\n"])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t, *_ in test:
        tokens = [*words(t), "\n"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((i is None, i or 0, len(tokens), sum(c[w] > 0 for w in tokens), n, round(base, 4)))
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got)
    assert rows == sorted(want)
    assert all(r.score < 0 for r in got)


def test_network_beats_frequencies_on_held_out_texts(spark, monkeypatch):
    for k, v in {"LEARNERS": 2, "LANES": 4, "WINDOW": 16}.items():
        monkeypatch.setattr(LM, k, v)
    train, test = corpus()[:200], corpus()[200:]
    model, counts = LM.fit(frame(spark, train), shape=SMALL)
    got = LM.score_documents(frame(spark, test), model, counts).collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    again = LM.score_documents(frame(spark, test[::-1]).repartition(3), model, counts).collect()
    a, b = ({r.doc_id: r.score for r in x} for x in (got, again))
    assert all(abs(a[i] - b[i]) < 1e-3 for i in a)


def test_every_text_takes_part_in_one_round(spark, monkeypatch):
    """4,000 texts, with 1,000 equal rows among them, by learners whose number
    grows with the tokens and whose networks are averaged in a tree."""
    seen = spark.sparkContext.accumulator(0)

    def counting(p, shape, stream, lanes, window, rate):
        seen.add(int((stream == 0).sum()) - 1)
        return {**p, "bias": p["bias"] + np.float32(len(stream))}

    for k, v in {"LEARNER_TOKENS": 1_000, "FAN_IN": 3}.items():
        monkeypatch.setattr(LM, k, v)
    monkeypatch.setattr(gru, "train", counting)
    rows = [(i, f"a{i} b{i % 7} c", "a", "s") for i in range(3_000)] + [(None, "same again", "a", "s")] * 1_000
    docs = frame(spark, rows).select("doc_id", "text")
    model, _ = LM.fit(docs, shape=SMALL)
    dealt = LM._encoded(docs, model, 15).groupBy("part", "learner").agg(F.sum(F.length("ids") / 2).alias("n")).collect()
    assert model.tokens == 15_000 and {r["part"] for r in dealt} == set(range(LM.ROUNDS)) and len(dealt) == 15 * LM.ROUNDS
    assert max(r["n"] for r in dealt) < 2 * 15_000 / len(dealt)
    assert seen.value == 4_000
    moved = 0  # in each round by the mean of the learners' stream lengths, weighted by length
    for part in range(LM.ROUNDS):
        sizes = [r["n"] + 1 for r in dealt if r["part"] == part]
        moved += sum(n * n for n in sizes) / sum(sizes)
    start = gru.start(SMALL, np.ones(1 + SMALL.head + SMALL.tail), 7)["bias"]
    assert np.allclose(model.net["bias"] - start, moved, rtol=1e-4)


@pytest.mark.parametrize("counted", [1, 50, 100, 130, 1000])
def test_the_counted_words_are_the_most_frequent(spark, monkeypatch, counted):
    """Also where more of them share a count than there is room for."""
    monkeypatch.setattr(LM, "COUNTED", counted)
    rows = [(f"w{i:03}", 5) for i in range(100)] + [(f"v{i:02}", 900 + i) for i in range(20)] + [("once", 1)]
    words, counts = LM._most_frequent(spark.createDataFrame(rows, "word string, c long"))
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:counted]
    assert list(zip(words.to_pylist(), counts.tolist())) == want


def test_probabilities_add_up(spark):
    """Over all words and an unknown one of each class, after any text."""
    model, counts = LM.fit(frame(spark, corpus()[:60]), shape=SMALL)
    vocabulary = sorted(r.word for r in counts.collect())
    unknown, k = {}, 0
    while len(unknown) < SMALL.tail:
        w = f"zz{k}"
        unknown.setdefault(int(LM.tail_class(pa.array([w]), SMALL.tail)[0]), w)
        k += 1
    before = "a1 b2 a7"
    rows = [(i, f"{before} {w}", None, None) for i, w in enumerate([*vocabulary, *unknown.values()])]
    by = {r.doc_id: r for r in LM.score_documents(frame(spark, rows), model, counts).collect()}
    end = {r.doc_id: r for r in LM.score_documents(frame(spark, [(-1, before, None, None)]), model, counts).collect()}[-1]
    net, shape = model.net, model.shape
    # the word's own part: take the end's probability after the word off each score
    total = 0.0
    for i, (_, text, *_) in enumerate(rows):
        ids_, _ = LM._ids(pa.array(text.split(), pa.large_string()), model.words, shape)
        h, logs = np.zeros((1, shape.hidden), np.float32), []
        for x, y in zip([0, *ids_], [*ids_, 0]):
            h = gru.step(net, np.array([x]), h)[0]
            logs.append(gru.log_prob(net, shape, h, np.array([y]))[0] / math.log(10))
        start = end.score - _last(net, shape, model, before)
        total += 10 ** (by[i].score - logs[-1] - start)
    total += 10 ** (end.score - (end.score - _last(net, shape, model, before)))
    assert abs(total - 1) < 1e-3


def _last(net, shape, model, text):
    ids_, _ = LM._ids(pa.array(text.split(), pa.large_string()), model.words, shape)
    h = np.zeros((1, shape.hidden), np.float32)
    for x in [0, *ids_]:
        h = gru.step(net, np.array([x]), h)[0]
    return gru.log_prob(net, shape, h, np.array([0]))[0] / math.log(10)


def test_gradients():
    shape = gru.Shape(head=64, tail=3, hidden=4)
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in gru.start(shape, rng.random(68) + 0.1, 1).items()}
    p["out"] *= 10
    x, y, h = rng.integers(0, 68, (5, 3)), rng.integers(0, 68, (5, 3)), rng.standard_normal((3, 4))
    y[0] = [0, 5, 66]

    def loss():
        s, total = h, 0.0
        for t in range(5):
            s = gru.step(p, x[t], s)[0]
            total -= gru.log_prob(p, shape, s, y[t]).sum()
        return total / 15

    g, _, value = gru.window_gradients(p, shape, x, y, h)
    assert abs(value - loss()) < 1e-6
    for name in p:
        flat, grad = p[name].reshape(-1), g[name].reshape(-1)
        for at in np.argsort(-np.abs(grad))[:4]:
            old, d = flat[at], 1e-5
            flat[at] = old + d
            up = loss()
            flat[at] = old - d
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * d) - grad[at]) < 1e-5, name


@pytest.mark.parametrize("window,held", [(1, 1), (7, 50), (1000, 1 << 16)])
def test_state_is_carried_over_windows(window, held):
    shape = gru.Shape(head=64, tail=3, hidden=4)
    rng = np.random.default_rng(2)
    p = gru.start(shape, rng.random(68) + 0.1, 2)
    offsets = np.array([0, 0, 30, 31, 95])
    ids_ = rng.integers(1, 68, 95)
    got = gru.score_texts(p, shape, ids_, offsets, window, held)
    for d in range(4):
        h, total, text = np.zeros((1, 4), np.float32), 0.0, ids_[offsets[d] : offsets[d + 1]]
        for x, y in zip([0, *text], [*text, 0]):
            h = gru.step(p, np.array([x]), h)[0]
            total += gru.log_prob(p, shape, h, np.array([y]))[0]
        assert abs(total - got[d]) < 1e-3


def test_odd_rows(spark):
    model, counts = LM.fit(frame(spark, ODD), shape=SMALL)
    rows = LM.score_documents(frame(spark, ODD), model, counts).collect()
    assert ids(rows) == ALL and all(np.isfinite([r.score, r.base_score]).all() for r in rows)
    assert LM.score_documents(empty(spark), model, counts).count() == 0
    model, counts = LM.fit(empty(spark), shape=SMALL)
    rows = LM.score_documents(frame(spark, ODD), model, counts).collect()
    assert ids(rows) == ALL and all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.base_score) for r in rows)


def test_windows_share_their_arrays():
    """Gradients do not depend on what an earlier window left in the scratch arrays, which later windows use again."""
    shape = gru.Shape(128, 8, 6)
    rng = np.random.default_rng(3)
    p = gru.start(shape, rng.random(137) + 0.1, 1)
    some, h, kept = gru.Scratch(), np.zeros((4, 6), np.float32), {}
    for turn, steps in enumerate((9, 5, 9)):
        x, y = rng.integers(0, 137, (2, steps, 4))
        got, new, loss = gru.window_gradients(p, shape, x, y, h, some=some)
        want, same, alone = gru.window_gradients(p, shape, x, y, h)
        assert all((got[k] == want[k]).all() for k in p) and (new == same).all() and loss == alone
        before, kept = kept, dict(some.kept)
        assert turn == 0 or all(kept[k] is before[k] for k in ("given", "steps", "gates", "classes", "d_given"))
        h = new


def test_outputs_and_lanes_bound_the_work_of_a_token():
    """A token is scored by the classes and by one block or the rarer words, and texts that run
    one after the other in lanes leave few places empty, however unequal they are."""
    assert LM.SHAPE.classes + max(gru.BLOCK, LM.SHAPE.tail) <= 100  # 161 when each class of rarer words was a class of its own
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 600, 3_000), [20_000, 7_000, 1, 1]])
    place, first, size = gru._lanes(lengths, LM.WINDOW)
    used = np.concatenate([np.arange(i, i + n) for i, n in zip(place, lengths)])
    assert len(used) == len(set(used.tolist())) and used.max() < size.sum()
    assert (np.diff(size) <= 0).all() and (size % LM.WINDOW == 0).all() and (first == np.cumsum(size) - size).all()
    assert size.sum() < lengths.sum() + gru.SIDE * LM.WINDOW and size[0] < 20_000 + LM.WINDOW
    lane = np.searchsorted(first, place, side="right")
    assert (lane == np.searchsorted(first, place + lengths - 1, side="right")).all()  # no text is in two lanes


@pytest.mark.parametrize("scale", [1, 1000])
def test_outputs_out_of_range_of_exp(scale):
    """Outputs whose exponentials would be infinite or 0 give the same as in double precision."""
    shape = gru.Shape(head=128, tail=5, hidden=6)
    rng = np.random.default_rng(6)
    p = gru.start(shape, rng.random(134) + 0.1, 3)
    for k in ("out", "word", "tail"):
        p[k] *= scale
    x, y, h = rng.integers(0, 134, (7, 9)), rng.integers(0, 134, (7, 9)), np.zeros((9, 6), np.float32)
    wide = {k: v.astype(np.float64) for k, v in p.items()}
    g, _, loss = gru.window_gradients(p, shape, x, y, h)
    want, _, other = gru.window_gradients(wide, shape, x, y, h.astype(np.float64))
    assert abs(loss - other) < 1e-4 * abs(other)
    assert all(np.allclose(g[k], want[k], rtol=1e-2, atol=1e-3 * np.abs(want[k]).max()) for k in p)
    states = rng.uniform(-1, 1, (9, 6)).astype(np.float32)
    assert np.allclose(gru.log_prob(p, shape, states, y[0]), gru.log_prob(wide, shape, states, y[0]), rtol=1e-4)


def test_texts_of_one_lane_do_not_meet(monkeypatch):
    """Each text is scored from an empty state, whatever shares its lane; the texts' order does not matter."""
    shape = gru.Shape(head=64, tail=3, hidden=4)
    rng = np.random.default_rng(5)
    p = gru.start(shape, rng.random(68) + 0.1, 2)
    texts = [rng.integers(1, 68, n) for n in rng.integers(0, 40, 30)]
    alone = [gru.score_texts(p, shape, t, np.array([0, len(t)]), 8)[0] for t in texts]
    monkeypatch.setattr(gru, "SIDE", 3)
    for order in (range(30), range(29, -1, -1)):
        chosen = [texts[i] for i in order]
        got = gru.score_texts(p, shape, np.concatenate(chosen), np.cumsum([0, *map(len, chosen)]), 8)
        assert np.allclose(got, [alone[i] for i in order], atol=1e-4)
    assert len(gru.score_texts(p, shape, np.zeros(0, np.int64), np.zeros(1, np.int64), 8)) == 0


@pytest.mark.parametrize("hidden", [3, 4])
def test_gradients_of_ids_seen_once_and_often(hidden):
    shape = gru.Shape(head=64, tail=3, hidden=hidden)
    rng = np.random.default_rng(8)
    p = {k: v.astype(np.float64) for k, v in gru.start(shape, rng.random(68) + 0.1, 1).items()}
    x = np.array([[5, 5, 5, 5], [5, 7, 7, 9], [66, 5, 5, 0], [7, 66, 8, 7], [5, 5, 7, 7]])
    y = rng.integers(0, 68, x.shape)
    assert gru._by_id(x.reshape(-1), 68)[2:4][1] == 4  # 0, 8, 9 and 66 are seen once or twice, 5 and 7 often
    g = gru.window_gradients(p, shape, x, y, np.zeros((4, hidden)))[0]["in"].copy()
    for i in range(68):
        for part in range(3):
            up, down = ({**p, "in": p["in"].copy()} for _ in range(2))
            up["in"][part, i, 1] += 1e-5
            down["in"][part, i, 1] -= 1e-5
            rise = gru.window_gradients(up, shape, x, y, np.zeros((4, hidden)))[2] - gru.window_gradients(down, shape, x, y, np.zeros((4, hidden)))[2]
            assert abs(rise / 2e-5 - g[part, i, 1]) < 1e-7
