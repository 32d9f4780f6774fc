"""Benchmark items in training text: a BM25 index with block-max WAND."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from leafline.llm.text import Shared, bare_words, chunks

K1, B = 1.2, 0.75
#: share of an item's score against itself from which a passage is retrieved
THRESHOLD = 0.6
#: share of word triples that question and answer must each have in the passage
OVERLAP = 0.5
#: items of one index; more items make more indexes, and a pass over the text for each
INDEX_ITEMS = 20_000
#: blocks of an index, at most, and items in a block, at least
BLOCKS, BLOCK_ITEMS = 64, 4
#: words in more than this share of the items are bounded per block, not per passage
COMMON = 0.2
GRAM = 3


def _grams(codes: list[int], n: int) -> set[tuple[int, ...]]:
    return {tuple(codes[i : i + n]) for i in range(len(codes) - n + 1)}


def split_answer(text: str) -> int:
    """How many of a text's pieces between spaces are the question: all but the
    last sentence, or three quarters of a single sentence."""
    pieces = text.split()
    ends = [i + 1 for i, w in enumerate(pieces[:-1]) if w[-1] in ".?!"]
    return ends[-1] if ends else max(1, len(pieces) * 3 // 4) if len(pieces) > 1 else len(pieces)


@dataclass
class Index:
    """Impacts are BM25 divided by an item's score against itself, so that one
    threshold holds for all items."""

    items: list  # item ids, in the order of the postings
    words: list[str]
    postings: list[tuple[np.ndarray, np.ndarray]]  # per word: item numbers, impacts
    block: int  # items in a block
    bounds: np.ndarray  # (words + 1, blocks): greatest impact of a rarer word
    common: np.ndarray  # (blocks): greatest sum of the common words' impacts
    parts: list[tuple[set, set]] = field(default_factory=list)  # triples of question and answer
    longest: int = 1


def build_index(items: list[tuple[object, str | None]]) -> Index | None:
    """An index of (id, text); items without a word are left out. None if no item is left."""
    texts = [(i, t, bare_words(pa.array([t], pa.string()))[0].to_pylist()) for i, t in items if t is not None]
    texts = sorted(((i, t, w) for i, t, w in texts if w), key=lambda x: (str(x[1]), str(x[0])))
    if not texts:
        return None
    vocabulary = {w: k for k, w in enumerate(sorted({w for *_, ws in texts for w in ws}))}
    coded = [[vocabulary[w] for w in ws] for *_, ws in texts]
    n, mean = len(texts), sum(map(len, coded)) / len(texts)
    df = np.bincount([c for cs in coded for c in set(cs)], minlength=len(vocabulary))
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    rows: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
    for i, cs in enumerate(coded):
        codes, tf = np.unique(cs, return_counts=True)
        impact = idf[codes] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(cs) / mean))
        for c, x in zip(codes.tolist(), (impact / impact.sum()).tolist()):
            rows[c].append((i, x))
    block = max(BLOCK_ITEMS, -(-n // BLOCKS))
    bounds, common = np.zeros((len(vocabulary) + 1, -(-n // block)), np.float32), np.zeros(n)
    for c, row in enumerate(rows):
        for i, x in row:
            if df[c] > max(1, COMMON * n):
                common[i] += x
            else:
                bounds[c, i // block] = max(bounds[c, i // block], x)
    parts = []
    for (_, text, _), cs in zip(texts, coded):
        head = len(bare_words(pa.array([" ".join(text.split()[: split_answer(text)])]))[0])
        halves = [cs[:head] or cs, cs[head:] or cs]
        parts.append(tuple(_grams(h, min(GRAM, len(h))) for h in halves))
    return Index(
        [i for i, *_ in texts], list(vocabulary), [(np.array([i for i, _ in r]), np.array([x for _, x in r])) for r in rows], block,
        bounds, np.maximum.reduceat(common, np.arange(0, n, block)).astype(np.float32), parts, max(map(len, coded)),
    )


def wand(index: Index, terms: list[int], blocks: set[int], threshold: float) -> list[tuple[int, float]]:
    """Every item of `blocks` whose impacts for the distinct `terms` add up to
    `threshold`. Lists are walked side by side in item order; the pivot is the
    first item that the greatest impacts of the lists up to it could lift to the
    threshold, and no item before it is looked at."""
    lists = [[0, *index.postings[t], float(index.postings[t][1].max())] for t in terms]
    out = []
    while True:
        lists = [x for x in lists if x[0] < len(x[1])]
        lists.sort(key=lambda x: x[1][x[0]])
        reach, pivot = 0.0, None
        for x in lists:
            reach += x[3]
            if reach >= threshold - 1e-9:
                pivot = int(x[1][x[0]])
                break
        if pivot is None:
            return out
        if pivot // index.block not in blocks:  # the block's bound is too low: pass over the whole block
            target = (pivot // index.block + 1) * index.block
        elif int(lists[0][1][lists[0][0]]) == pivot:
            score = sum(float(x[2][x[0]]) for x in lists if x[1][x[0]] == pivot)
            if score >= threshold - 1e-9:
                out.append((pivot, score))
            target = pivot + 1
        else:
            target = pivot
        for x in lists:
            if x[1][x[0]] < target:
                x[0] += int(np.searchsorted(x[1][x[0] :], target))


def find(index: Index, texts: pa.Array, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[dict[int, tuple]]:
    """For each text {item number: (score, question overlap, answer overlap)}.

    Passages are three strides long and begin at every stride, where two strides
    hold the longest item; so each run of that many words lies in one passage.
    All passages are first held against the blocks' bounds, in numpy."""
    flat, offsets = bare_words(texts)
    codes = pc.fill_null(pc.index_in(flat, value_set=pa.array(index.words, pa.large_string())), len(index.words))
    codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
    stride = max(8, -(-index.longest // 2))
    counts = -(-np.diff(offsets) // stride)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(doc)) - np.repeat(ends - counts, counts)
    starts = offsets[:-1][doc] + number * stride
    out: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
    if not len(starts):
        return out
    # some strides at a time: a row of bounds for each word of a chunk would not fit
    group, edges = max(1, (1 << 22) // (stride * index.bounds.shape[1])), np.append(starts, len(codes))
    sums = np.concatenate(
        [
            np.add.reduceat(index.bounds[codes[edges[i] : edges[min(i + group, len(starts))]]], starts[i : i + group] - starts[i], axis=0)
            for i in range(0, len(starts), group)
        ]
    )
    last = ends[doc] - 1
    at = np.arange(len(doc))
    bound = sums + np.where((at + 1 <= last)[:, None], sums[np.minimum(at + 1, len(sums) - 1)], 0)
    bound += np.where((at + 2 <= last)[:, None], sums[np.minimum(at + 2, len(sums) - 1)], 0)
    possible = bound + index.common >= threshold - 1e-4
    for k in np.flatnonzero(possible.any(axis=1)).tolist():
        passage = codes[starts[k] : min(starts[k] + 3 * stride, offsets[doc[k] + 1])]
        terms = np.unique(passage)
        blocks = np.flatnonzero(possible[k])  # once more, now each word counts once
        blocks = blocks[index.bounds[terms][:, blocks].sum(axis=0) + index.common[blocks] >= threshold - 1e-4]
        if not len(blocks):
            continue
        passage, terms = passage.tolist(), terms[terms < len(index.words)].tolist()
        triples: dict[int, set] = {}
        for item, score in wand(index, terms, set(blocks.tolist()), threshold):
            shares = []
            for part in index.parts[item]:
                n = len(next(iter(part)))
                seen = triples.setdefault(n, _grams(passage, n))
                shares.append(len(part & seen) / len(part))
            if min(shares) >= overlap:
                out[doc[k]][item] = max(out[doc[k]].get(item, (0.0,)), (score, *shares))
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, overlap: float = OVERLAP, index_items: int = INDEX_ITEMS, keep: list[str] | None = None,
) -> DataFrame:
    """The rows of `docs` (their columns `keep`, or all) with column `leaks`, array of (item_id, score,
    question, answer) in the order of ids: the items of which some passage of the
    text has a BM25 score of `threshold` times the item's own or more, and holds
    `overlap` of the word triples of its question and of its answer each. Empty
    for clean, null and empty texts. Part of one word or two is compared whole.
    Null and empty items match nothing; equal items are all reported; a column
    `leaks` of `docs` is replaced, all others are kept as they are.

    The items are the query set: at most `index_items` of them are broadcast at
    a time, and further items take further passes over the text, each with an
    index and word statistics of its own. No text is shuffled."""
    items = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    wanted = [c for c in keep or docs.columns if c != "leaks"]
    total = items.count()
    passes = max(1, -(-total // index_items))
    kind = items.schema["i"].dataType.simpleString()
    leak = f"array<struct<item_id: {kind}, score: double, question: double, answer: double>>"
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(leak))
    for k in range(passes):
        share = items if passes == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == k)
        index = build_index([tuple(r) for r in share.collect()])
        if index is None:
            continue
        shared = Shared(docs.sparkSession, index)
        names = [*wanted, "leaks"] if k == passes - 1 else out.columns
        schema = StructType([out.schema[n] for n in names])
        out = out.mapInArrow(_matcher(shared, text, threshold, overlap, schema), schema)
    return out.select(*wanted, "leaks")


def _matcher(shared, text: str, threshold: float, overlap: float, schema: StructType):
    kind, names = to_arrow_type(schema["leaks"].dataType), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in chunks(batches, text):
            found = find(index, b.column(text), threshold, overlap)
            had = b.column("leaks").to_pylist()
            rows = [
                sorted(
                    [*(h or []), *({"item_id": index.items[i], "score": s, "question": q, "answer": a} for i, (s, q, a) in f.items())],
                    key=lambda x: (x["item_id"] is None, x["item_id"]),
                )
                for h, f in zip(had, found)
            ]
            arrays = [pa.array(rows, kind) if n == "leaks" else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run
