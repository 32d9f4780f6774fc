"""Periodic runs against every stretch of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from leafline.llm import periodic
from leafline.llm import queries as Q
from tests.llm.helpers import ALL, ODD, empty, frame, ids

SF_DIR = "/root/testdata/sf0.001"


def brute(words, least=12):
    """All runs by trying every period at every place."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)  # smaller periods came first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases():
    rnd = random.Random(3)
    for _ in range(300):
        yield rnd.choices("ab", k=rnd.randint(0, 60))
    for _ in range(300):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            unit = rnd.choices("abcdefgh", k=rnd.randint(1, 15))
            parts += unit * rnd.randint(1, 6) + unit[: rnd.randint(0, len(unit))] + [f"x{rnd.random()}"] * rnd.randint(0, 1)
        yield parts
    yield list("abcdef") * 2  # twelve words, twice a period
    yield list("abcde") * 2 + ["a"]  # eleven
    yield ["a"] * 12 + ["b"] * 12


@pytest.mark.parametrize("direct", [4096, 0, 20])
def test_segments_and_lags_find_all_runs(monkeypatch, direct):
    monkeypatch.setattr(periodic, "DIRECT", direct)
    every = list(cases())
    flat = [w for c in every for w in c]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    offsets = np.cumsum([0, *map(len, every)])
    table, repeated = periodic._texts_runs(np.array([number[w] for w in flat], np.int64), offsets, 12)
    for k, words in enumerate(every):
        want = brute(words)
        assert [tuple(r[1:]) for r in table[table[:, 0] == k].tolist()] == sorted(want, key=lambda r: (r[0], r[2]))
        mine = repeated[offsets[k] : offsets[k + 1]]
        assert " ".join(w for w, x in zip(words, mine) if not x) == collapse(words, want)


def test_long_texts_take_little_time():
    words = np.concatenate([np.arange(6000), np.arange(6000), np.zeros(30_000), np.arange(9000) % 4500]).astype(np.int64)
    got = {(s, n, q) for s, n, q in periodic.scan_lags(words)}
    equal = lambda s, n, q: (words[s : s + n - q] == words[s + q : s + n]).all()
    assert {q for _, _, q in got} >= {1, 6000, 4500} and all(equal(*r) for r in got)
    for s, n, q in got:
        assert not (s and equal(s - 1, n + 1, q)) and not (s + n < len(words) and equal(s, n + 1, q))
    assert len(periodic.surviving_segments(np.arange(200_000), np.array([0, 200_000]))) == 0


def test_segments_are_cut_until_nothing_changes():
    # b is alone once a singleton has split its segment
    words = list("ab") * 2 + ["x"] + list("cb") + list("aaaaaaaaaaaa") + ["y"] + list("cd") * 3
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    flat = np.array([number[w] for w in words])
    assert periodic.surviving_segments(flat, np.array([0, len(flat)])) == [(7, 19)]


def test_documents(spark):
    loop = "Uno due\ttre\n" * 7
    rows = [*ODD, (30, loop, "it", "c"), (31, "uno Uno " * 3 + "a " * 13, None, None)]
    got = periodic.find_runs(frame(spark, rows)).collect()
    assert ids(got) == sorted([*ALL, 30, 31], key=lambda x: (x is None, x))
    by = {}
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = sorted(brute(words) if len(words) < 1000 else [], key=lambda r: (r[0], r[2]))
        by.setdefault(i, []).append((runs, collapse(words, runs)))
    for r in got:
        if r.doc_id != 8:
            assert ([tuple(x) for x in r.runs], r.collapsed) in by[r.doc_id]
    assert [tuple(x) for x in next(r for r in got if r.doc_id == 30).runs] == [(0, 21, 3)]
    assert periodic.find_runs(empty(spark)).count() == 0


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in Q.op11_periodic_runs(spark, SF_DIR).collect()}
    assert set(got) == set(docs)
    planted = 0
    for i, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        if n > 1500:
            continue
        runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert tuple(got[i]) == (
            i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapse(words, runs)),
        )
    assert planted > 5
