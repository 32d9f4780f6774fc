from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leafline.llm import leaks as L
from leafline.llm.text import bare_words
from tests.llm.helpers import ALL, LONG, ODD, empty, frame, ids

ITEMS = [
    (1, "Which river runs through the old town of Arlen? It is the slow green Vess, as all maps show."),
    (2, "Name the third king of the northern isles and his youngest daughter"),
    (3, "Which river runs through the old town of Arlen? It is the slow green Vess, as all maps show."),
    (4, None), (5, ""), (6, "?!"), (7, "Zyzzyva"),
    (None, "How many legs has a common garden spider that lives near the lake? Eight legs."),
]
FILL = " ".join(f"filler{i} and the of" for i in range(200))


def docs(spark):
    t = {i: x for i, x in ITEMS}
    rows = [
        (100, FILL + " " + t[1].upper() + " " + FILL, "en", "a"),
        (101, t[1].split("?")[0] + "?", "en", "a"),  # the question alone
        (102, FILL + " " + t[2] + "*** " + t[None], "en", "a"),
        (103, LONG + " (zyzzyva).", "en", "a"),
        (104, t[1].replace("old", "very").replace("green", "blue"), "en", "a"),
        (105, " ".join(sorted(t[1].split())), "en", "a"),  # the words, not the text
    ]
    return frame(spark, rows + ODD)


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("index_items", [20_000, 2])
def test_leaks_are_found_and_clean_rows_are_kept(spark, index_items):
    got = L.decontaminate(docs(spark), items(spark), index_items=index_items)
    assert got.columns == [c for c in docs(spark).columns if c != "leaks"] + ["leaks"]
    rows = got.collect()
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in rows if r.leaks}
    assert found == {100: [1, 3], 102: [2, None], 103: [7], 104: [1, 3]}
    assert Counter(ids(rows)) == Counter([*ALL, *range(100, 106)])


def test_no_items_and_no_documents(spark):
    none = L.decontaminate(docs(spark), items(spark).limit(0), keep=["doc_id"])
    assert none.columns == ["doc_id", "leaks"] and not any(r.leaks for r in none.collect())
    assert L.decontaminate(empty(spark), items(spark)).count() == 0


def test_wand_equals_scoring_everything():
    rnd = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(80)]
    texts = [(i, " ".join(rnd.choice(vocabulary, rnd.integers(3, 15)))) for i in range(60)]
    index = L.build_index(texts)
    for _ in range(40):
        terms = sorted(set(rnd.integers(0, len(index.words), 12).tolist()))
        total = np.zeros(60)
        for t in terms:
            total[index.postings[t][0]] += index.postings[t][1]
        every = set(range(-(-60 // index.block)))
        for threshold in (0.1, 0.3, 0.6):
            got = dict(L.wand(index, terms, every, threshold))
            assert set(got) == set(np.flatnonzero(total >= threshold).tolist())
            assert all(abs(total[i] - s) < 1e-9 for i, s in got.items())


def test_bounds_leave_out_no_passage(monkeypatch):
    rnd = np.random.default_rng(5)
    vocabulary = [f"v{i}" for i in range(60)]
    texts = [(i, " ".join(rnd.choice(vocabulary, 12))) for i in range(40)]
    index = L.build_index(texts)
    body = [" ".join(rnd.choice(vocabulary, 200)) + " " + texts[k][1] + " " + " ".join(rnd.choice(vocabulary, 50)) for k in range(40)]
    got = L.find(index, pa.array(body), threshold=0.5, overlap=0.0)
    # all passages scored in full
    flat, offsets = bare_words(pa.array(body))
    code = {w: i for i, w in enumerate(index.words)}
    stride = max(8, -(-index.longest // 2))
    for d in range(40):
        cs = [code[w] for w in flat[int(offsets[d]) : int(offsets[d + 1])].to_pylist()]
        want = set()
        for s in range(0, len(cs), stride):
            total = np.zeros(40)
            for t in set(cs[s : s + 3 * stride]):
                total[index.postings[t][0]] += index.postings[t][1]
            want |= set(np.flatnonzero(total >= 0.5).tolist())
        assert set(got[d]) == want and any(index.items[i] == d for i in got[d])


def test_split_of_question_and_answer():
    assert L.split_answer("Who was it? It was me.") == 3
    assert L.split_answer("one two three four") == 3
    assert L.split_answer("one") == 1
