"""Exact duplicates, languages, shards, url rules, token files."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from leafline.llm import exact_dedup, lang_id, sharding, token_scan, url_rules
from leafline.session import scratch_path
from tests.llm.helpers import ALL, LONG, ODD, empty, frame, ids, words


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("prefix, crowded", [(1, 1000), (64, 1000), (64, 1), (64, 5)])
def test_exact_duplicates(spark, monkeypatch, prefix, crowded):
    """All repeated texts crowded, none, or some."""
    monkeypatch.setattr(exact_dedup, "CROWDED", crowded)
    rows = ODD + [(20, LONG + "y", "en", "a"), (21, LONG + "z", "en", "a")]
    got = exact_dedup.deduplicate(frame(spark, rows), prefix=prefix).collect()
    groups = Counter(lower(r[1]) for r in rows)
    sha = {lower(r[1]): hashlib.sha256(lower(r[1]).encode()).hexdigest() for r in rows}
    keep = {}
    for i, t, *_ in rows:
        keep[lower(t)] = max((x for x in (keep.get(lower(t)), i) if x is not None), default=None)
    want = Counter((i, keep[lower(t)], groups[lower(t)], i == keep[lower(t)], sha[lower(t)]) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in got) == want
    assert exact_dedup.deduplicate(empty(spark)).count() == 0


SPEECH = {
    "en": "the house of the old man and the sea with nothing but water that would not end",
    "fr": "la maison du vieil homme et la mer avec rien que de l'eau qui ne finirait pas",
}


def test_languages(spark):
    rows = [(i, " ".join(s.split()[i % 5 :] + s.split()[: i % 5]), k, None) for i in range(20) for k, s in SPEECH.items()]
    model = lang_id.fit(frame(spark, rows + [(99, None, "en", None), (98, "text", None, None)]))
    assert model.langs == ["en", "fr"]
    got = lang_id.identify(frame(spark, ODD), model).collect()
    assert ids(got) == ALL
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: by[i].lang_pred for i in (3, 4, 5, 6, -9, 1)} == {3: "und", 4: "und", 5: "und", 6: "und", -9: "fr", 1: "en"}
    assert all(0 <= r.score <= 1 for r in got) and by[4].score == 0
    assert lang_id.identify(empty(spark), model).count() == 0
    kept = lang_id.keep_determined(frame(spark, ODD), model)
    assert kept.columns == frame(spark, []).columns and Counter(ids(kept.collect())) == Counter([1, 1, 2, 7, 8, -9, 9, None])
    nothing = lang_id.fit(empty(spark))
    assert {r.lang_pred for r in lang_id.identify(frame(spark, ODD), nothing).collect()} == {"und"}


def test_every_labelled_text_is_learned_from(spark):
    """One language is that of a single text among 6,500; counters are handed on when languages are many."""
    rows = [(i, f"the word{i % 7}", "en", None) for i in range(6_500)] + [(-i, f"le {k}", f"l{i}", None) for i, k in enumerate("abc", 1)]
    known = lang_id.labelled(frame(spark, rows))
    assert known.count() == len(rows)
    model = lang_id.fit(frame(spark, rows))
    assert model.langs == ["en", "l1", "l2", "l3"]
    np.testing.assert_allclose(np.exp(model.prior), [6_500 / 6_503] + [1 / 6_503] * 3)


def test_more_languages_than_a_task_counts_at_a_time(spark, monkeypatch):
    rows = [(i, f"{s} {i % 3}", k, None) for i in range(4) for k, s in SPEECH.items()]
    want = lang_id.fit(frame(spark, rows)).weights
    monkeypatch.setattr(lang_id, "COUNTED_LANGS", 1)
    monkeypatch.setattr(lang_id, "SCORE_BYTES", 100)
    np.testing.assert_array_equal(lang_id.fit(frame(spark, rows)).weights, want)


@pytest.mark.parametrize("bins", [2, 3, 1024])
def test_medians_of_any_number_of_values(spark, monkeypatch, bins):
    monkeypatch.setattr(lang_id, "BINS", bins)
    rnd = np.random.default_rng(2)
    for values in ([], [3.0], [1.0, 2.0], [1.0, 1.0, 7.0], [-5.0] * 4 + [2.0] * 4, [0.0, 1.0, 1.0, 1.5, 9e9], (-rnd.pareto(1, 40)).round(1).tolist()):
        got = lang_id.exact_median(spark.createDataFrame([(v,) for v in values], "m double"))
        assert got == (np.median(values) if values else None)


def test_texts_in_no_known_language_go(spark):
    rnd = np.random.default_rng(1)
    letters = "".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz   "), 400))
    clean = [(100 + i, " ".join(s.split()[i % 5 :] + s.split()[: i % 5]), k, None) for i in range(400) for k, s in SPEECH.items()]
    late = SPEECH["en"] * 3
    odd = [(50, letters, None, None), (51, "этот текст на другом языке " * 9, None, None), (52, "12 34", None, None), (53, None, "en", None), (54, "", "fr", None)]
    short = [(60, "hm", None, None), (61, "OK!", None, None), (62, late, None, None)]
    rows = frame(spark, clean + odd + short)
    sample = lang_id.labelled(rows)
    model = lang_id.fit_sample(sample)
    level = lang_id.typical_level(sample, model)
    assert -12 < level < -2
    kept = lang_id.keep_determined(rows, model, level)
    assert kept.columns == rows.columns and ids(kept.collect()) == sorted([60, 61, 62] + [r[0] for r in clean])
    nothing = lang_id.fit(empty(spark))
    assert lang_id.typical_level(lang_id.labelled(empty(spark)), nothing) == -np.inf
    assert ids(lang_id.keep_determined(frame(spark, odd + short), nothing).collect()) == [50, 51, 60, 61, 62]


def test_prediction_is_that_of_naive_bayes(spark):
    """Counted and multiplied independently, n-gram by n-gram, with the prior."""
    rows = [(i, " ".join(s.split()[i % 7 :]), k, None) for i in range(6) for k, s in SPEECH.items()] + [(9, SPEECH["fr"], "fr", None)] * 3
    model = lang_id.fit(frame(spark, rows))

    def grams_of(text):
        return [x for g, _ in lang_id.grams([text], lang_id.BITS) for x in g.tolist()]

    counts = {k: Counter(x for _, t, lang, _ in rows if lang == k for x in grams_of(t)) for k in SPEECH}
    prior = Counter(r[2] for r in rows)

    def log_joint(text, k):
        n = sum(counts[k].values()) + lang_id.SMOOTHING * 2**lang_id.BITS
        return np.log(prior[k] / len(rows)) + sum(np.log((counts[k][x] + lang_id.SMOOTHING) / n) for x in grams_of(text))

    texts = [s[i : i + j] for s in SPEECH.values() for i in range(0, 40, 7) for j in (3, 15, 60)] + [SPEECH["en"] * 20 + SPEECH["fr"] * 19]
    pred, score = lang_id.predict(texts, model)
    assert pred == [max(sorted(SPEECH), key=lambda k: log_joint(t, k)) for t in texts]
    for t, s, k in zip(texts, score, pred):
        if len(grams_of(t)) <= lang_id.EVIDENCE:
            want = 1 / sum(np.exp(log_joint(t, x) - log_joint(t, k)) for x in SPEECH)
            assert s == pytest.approx(want, abs=1e-4)


def test_whole_texts_decide_and_batches_do_not_mix(spark):
    model = lang_id.fit(frame(spark, [(i, s, k, None) for i, (k, s) in enumerate(SPEECH.items())]))
    late = " ".join([SPEECH["en"]] * 3 + [SPEECH["fr"]] * 30)
    together = lang_id.scores([SPEECH["en"], late, "É", "x"], model)
    alone = np.concatenate([lang_id.scores([t], model) for t in (SPEECH["en"], late, "É", "x")])
    assert np.allclose(together, alone) and together[1].argmax() == 1


def test_grams_by_hand():
    got = [(sorted(g.tolist()), o.tolist()) for g, o in lang_id.grams(["Ab1c", ""], 15)]
    again = [(sorted(g.tolist()), o.tolist()) for g, o in lang_id.grams(["ab, c", ""], 15)]
    assert got == again and [o for _, o in got] == [[0, 6, 7], [0, 5, 5], [0, 4, 4]]


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000])
def test_feistel_is_a_permutation(n):
    at = sharding.feistel(np.arange(n), n, 5)
    assert sorted(at.tolist()) == list(range(n))
    assert (at == sharding.feistel(np.arange(n), n, 5)).all()


def test_shards(spark):
    got = sharding.shard_documents(frame(spark, ODD), 4).collect()
    assert ids(got) == ALL and sorted(r.row for r in got) == list(range(len(ODD)))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(4)) <= 1
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    shard, slot = sharding.place(np.array([r.row for r in got]), len(got), 4, 0)
    assert shard.tolist() == [r.shard for r in got] and slot.tolist() == [r.slot for r in got]
    body = {(r[0], (r[1] or "").encode()) for r in ODD}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len(b) + 8, zlib.crc32(b)) for i, b in body}
    again = sharding.shard_documents(frame(spark, ODD[::-1]).repartition(3), 4).collect()
    place = lambda rows: Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows)
    assert place(again) == place(got)
    assert sharding.shard_documents(empty(spark), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(empty(spark), 0)


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("b.example.net", "/", "allow"),
    ("", "/ban", "block"), ("Org", None, "block"), ("dup.io", "/", "allow"), ("dup.io", "/", "block"),
]
URLS = [
    "http://a.net/", "http://net/x", "http://net", "https://A.EXAMPLE.net/en/1?x=/en/x", "http://example.net/en/xy#z", "http://b.example.net/en/xy",
    "http://c.b.example.net/q", "http://notexample.net/en/", "http://x.com/banned", "http://x.com/q/ban", "no url", None, "://", "http:///ban",
    "http://e.org", "http://e.org?q", "http://dup.io/1", "ftp://u://net/p", "http://a.net/", "http://example.net./en/",
]


def brute(url, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = lower(rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for h, p, v in RULES:
        h, p = lower(h), p or ""
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), h + p, v))
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, default)


@pytest.mark.parametrize("sizes, crowded", [({}, 1000), ({"range_prefixes": 1, "sweep_keys": 2}, 1), ({}, 6)])
def test_url_rules(spark, monkeypatch, sizes, crowded):
    """All hosts and addresses crowded, none, or some."""
    monkeypatch.setattr(url_rules, "CROWDED", crowded)
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id int, url string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, rules, default="maybe", **sizes).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: brute(u, "maybe") for i, u in enumerate(URLS)}
    assert len(got) == len(URLS)
    none = url_rules.judge_urls(pages, rules.limit(0)).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")} and len(none) == len(URLS)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_a_crowded_address_is_dealt_out(spark):
    """Half of the pages have no url and a quarter one url: their rows meet in no one partition."""
    urls = [None] * 400 + ["http://www.org/fr/x"] * 200 + [f"http://h{i}.net/{i}" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = url_rules.judge_urls(pages, rules, default="maybe")
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {i: brute(u, "maybe") for i, u in enumerate(urls)}
    assert len(per_task) > 4 and max(per_task) < 200


def test_no_python_in_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = url_rules.judge_urls(pages, rules)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop")), plan


@pytest.mark.parametrize("block,group", [(1 << 20, 1024), (4, 2), (8, 3), (12, 1), (64, 2)])
def test_token_files(spark, block, group):
    rows = [r for r in ODD if r[1] != LONG] + [(2**62 + 5, "a b", None, None), (-(2**63) + 1, "c", None, None)]
    path = scratch_path(spark, "tokens")
    token_scan.write_token_files(frame(spark, rows).repartition(2), path)
    got = token_scan.count_tokens(spark, path, block, group).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], len(words(r[1]))) for r in rows)


def test_token_counts_of_long_and_no_texts(spark):
    got = token_scan.document_lengths(frame(spark, ODD), block=4096).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], len(words(r[1]))) for r in ODD)
    assert token_scan.document_lengths(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        token_scan.count_tokens(spark, "x", 6)
