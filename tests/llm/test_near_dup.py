import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leafline.llm import near_dup as N
from leafline.llm.components import components
from tests.llm.helpers import ODD, empty, frame, words


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Component id of each row, by all pairs."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows))


def family(rnd, base, n, edits):
    for _ in range(n):
        w = base.split()
        for _ in range(rnd.randrange(edits + 1)):
            at = rnd.randrange(len(w))
            w[at : at + 1] = rnd.choice([[], [f"e{rnd.randrange(10**6)}"], [w[at], f"i{rnd.randrange(10**6)}"]])
        yield " ".join(w)


def corpus(seed=1):
    rnd = random.Random(seed)
    new = lambda n: " ".join(f"t{rnd.randrange(5000)}" for _ in range(n))
    shared, texts = new(60), []
    for size, n, edits in ((30, 25, 2), (80, 40, 4), (200, 30, 12), (9, 12, 1), (1500, 4, 30)):
        texts += family(rnd, new(size), n, edits)
    texts += [new(40) + " " + shared + " " + new(rnd.choice([10, 60])) for _ in range(40)]  # one passage, no copies
    texts += [shared + " " + new(3) for _ in range(12)] + [new(rnd.randrange(1, 12)) for _ in range(30)]
    texts += [texts[0]] * 20
    rnd.shuffle(texts)
    return [(i * 7 % 997, t, "en", "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize("limits", [{}, {"SLICE_SETS": 6, "ROUNDS": 1}, {"SLICE_SHINGLES": 300, "ROUNDS": 4, "FREQUENT": 3}])
def test_components_equal_brute_force(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(N, k, v)
    rows = corpus()
    got = Counter(map(tuple, N.near_duplicates(frame(spark, rows).repartition(4)).collect()))
    assert got == brute(rows)


def test_odd_rows(spark):
    assert Counter(map(tuple, N.near_duplicates(frame(spark, ODD)).collect())) == brute(ODD)
    assert N.near_duplicates(empty(spark)).count() == 0
    kept = N.keep_one(frame(spark, ODD))
    assert kept.columns == frame(spark, []).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, None, 7, 8, -9, 9])
    assert N.keep_one(empty(spark)).count() == 0


def test_one_of_each_component_stays(spark):
    rows = corpus(2)
    got = N.keep_one(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted({c for _, _, c in brute(rows)})


def test_tree_finds_what_all_pairs_find():
    rnd = np.random.default_rng(4)
    for trial in range(20):
        pool = rnd.integers(-(2**62), 2**62, 60)
        sets = [np.unique(rnd.choice(pool, rnd.integers(1, 50), replace=False)) for _ in range(40)]
        sets += [np.unique(np.append(s[: max(1, len(s) - 1)], rnd.integers(0, 9, 1))) for s in sets[:20]]
        want = {
            (i, j)
            for i in range(len(sets))
            for j in range(i)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
        }
        found = N.tree_links(sets, list(range(len(sets))))
        assert {(max(p), min(p)) for p in found} <= want
        root = list(range(len(sets)))
        for edges in (found, want):
            parent = list(range(len(sets)))
            for _ in sets:
                for i, j in edges:
                    parent[i] = parent[j] = min(parent[i], parent[j])
            if edges is found:
                root = parent
        assert root == parent


def test_bounds_never_rule_out_a_link():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rnd.integers(-(2**62), 2**62, rnd.integers(1, 40)))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.9], rnd.integers(0, 2**62, rnd.integers(0, 4))]))
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        c = np.unique(rnd.integers(0, 2**62, 20))
        for sets in ([a, b], [a, b, c], [c, b, c, a]):
            got = {frozenset(p) for p in N.candidates([len(s) for s in sets], [N.signature(s) for s in sets], list(range(len(sets))))}
            assert frozenset(i for i, s in enumerate(sets) if s is not c) in got


def test_sets_of_one_label_are_passed_over():
    s = np.arange(30)
    bits = [N.signature(s)] * 40
    assert not list(N.candidates([30] * 40, bits, [7] * 40))
    assert len(list(N.candidates([30] * 40, bits, [7] * 39 + [8]))) == 39


def test_prefixes_of_linked_sets_meet():
    for n in range(1, 300):
        assert n - N.prefix_length(n) + 1 == -(-3 * n // 4)


def test_set_hash_and_shingles():
    a, b, c = N.shingle_sets(pa.array(["a b c d e f", "x a b c d e f", "A B c d E f"]))
    assert N.set_hash(a) == N.set_hash(c) and set(a) < set(b) and len(b) == 3
    assert [len(s) for s in N.shingle_sets(pa.array(["", None, "a b", "b a"]))] == [0, 0, 1, 1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 540)] + [(9999, 9999), (-5, -3), (-3, -5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 500 for i in range(500, 540)}, -5: -5, -3: -5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
