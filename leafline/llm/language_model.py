"""Log-likelihood of whole documents under a recurrent language model."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm import gru
from leafline.llm.text import Shared, chunks, segment_sums, words
from leafline.session import materialize

#: words with an id of their own in the network, and classes of all other words
SHAPE = gru.Shape(head=2048, tail=64, hidden=24)
#: so many of the most frequent words, at most, travel with the model; counts of
#: others are joined
COUNTED = 200_000
#: the network's weights are fitted on all training documents, a part of them in
#: each round, by learners side by side with about so many tokens each, so many learners at
#: least; their weights are averaged after each round, FAN_IN networks at a time
LEARNER_TOKENS, LEARNERS, ROUNDS, FAN_IN = 2_000_000, 6, 3, 16
LANES, WINDOW, RATE = 128, 32, 0.03
#: bytes of text that are scored side by side
SCORE_BYTES = 12 << 20


@dataclass
class Model:
    words: pa.Array  # the most frequent words, in order
    counts: np.ndarray
    tokens: int  # N: training tokens, ends included
    distinct: int  # V
    texts: int  # training texts, so ends
    shape: gru.Shape
    mass: np.ndarray  # of each class of rarer words: its words' (count + 0.5), and 0.5 for unknown ones
    net: dict


def tail_class(strings: pa.Array, classes: int) -> np.ndarray:
    """A word's class among rarer words, from its last two bytes."""
    strings = strings.cast(pa.large_string())
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64)
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int64)[strings.offset : strings.offset + n + 1]
    raw = np.frombuffer(data, np.uint8).astype(np.uint32) if data is not None else np.zeros(1, np.uint32)
    last = raw[np.maximum(ends[1:] - 1, 0)]
    before = np.where(np.diff(ends) > 1, raw[np.maximum(ends[1:] - 2, 0)], 0)
    return (((last * 257 + before) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % classes


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches, "text"):
        found = words(b.column("text"))[0].value_counts()
        yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], ["word", "c"])


def _ids(flat: pa.Array, vocabulary: pa.Array, shape: gru.Shape) -> tuple[np.ndarray, np.ndarray]:
    """(id for the network, place among the counted words or -1) of each word."""
    at = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rare = (at < 0) | (at >= shape.head)
    ids = at + 1
    ids[rare] = shape.head + 1 + tail_class(flat.filter(pa.array(rare)), shape.tail)
    return ids, at


def _most_frequent(counts: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """The COUNTED most frequent words with their counts, the most frequent
    first, then in word order. What can be among them is read off a histogram of
    counts, so that no task sorts or sends many more words than these."""
    step = F.floor(F.log2("c") * 16)
    room, least, full = COUNTED, None, None
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("step")).collect():
        if r["n"] > room:
            full = r["step"]
            break
        room, least = room - r["n"], r["c"]
    kept = counts.where(F.col("c") >= least) if least is not None else counts.limit(0)
    if full is not None and room:
        kept = kept.unionByName(counts.where(step == full).orderBy(F.desc("c"), "word").limit(room))
    table = kept.toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    return table["word"].combine_chunks().cast(pa.large_string()), table["c"].to_numpy()


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: gru.Shape = SHAPE) -> tuple[Model, DataFrame]:
    """(model, counts): counts (word, c) of all words of all rows of `docs`, and
    a network fitted on all of them as well. Null texts are empty, and
    each text has one end. No rows give a model of the unknown word alone."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counted = slim.select("text").mapInArrow(_counts, "word string, c long")
    counts = materialize(counted.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    texts = slim.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    vocabulary, known = _most_frequent(counts)
    head = min(shape.head, len(known) // gru.BLOCK * gru.BLOCK)
    shape = gru.Shape(head, shape.tail, shape.hidden)

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mass = np.bincount(tail_class(b.column("word"), shape.tail), b.column("c").to_numpy() + 0.5, minlength=shape.tail)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape.tail)), pa.array(mass)], ["g", "m"])

    mass = np.full(shape.tail, 0.5)
    for r in counts.mapInArrow(masses, "g long, m double").groupBy("g").agg(F.sum("m").alias("m")).collect():
        mass[r["g"]] += r["m"]
    mass -= np.bincount(tail_class(vocabulary[:head], shape.tail), known[:head] + 0.5, minlength=shape.tail)
    start = gru.start(shape, np.concatenate([[texts + 0.5], known[:head] + 0.5, mass]), seed=7)
    model = Model(vocabulary, known, total["n"] + texts, total["v"] + (texts > 0), texts, shape, mass, start)
    model.net = _train(slim, model)
    return model, counts


def _learner(shared, shape: gru.Shape, rate: float):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One network from all texts of a task, which are those of one learner."""
        found = [b for b in batches if b.num_rows]
        if found:
            texts = pa.Table.from_batches(found).sort_by([("h", "ascending"), ("turn", "ascending")])
            stream = np.concatenate([[0], *(np.frombuffer(b, shape.id_type) for b in texts.column("ids").to_pylist())])
            p = gru.train(shared.value, shape, stream.astype(np.int64), LANES, WINDOW, rate)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0].column("learner")[:1], pa.int64()), pa.array([len(stream)]), pa.array([pickle.dumps(p)], pa.binary())],
                ["learner", "n", "net"],
            )

    return learn


def _average(group: pa.Table) -> pa.Table:
    """One network from several, by their tokens."""
    group = group.sort_by("learner")
    ns, total = group.column("n").to_pylist(), None
    for n, net in zip(ns, group.column("net")):
        p = {k: v * (n / sum(ns)) for k, v in pickle.loads(net.as_py()).items()}
        total = p if total is None else {k: total[k] + p[k] for k in total}
    net = pickle.dumps({k: v.astype(np.float32) for k, v in total.items()})
    return pa.table([group.column("up")[:1], pa.array([sum(ns)]), pa.array([net], pa.binary())], names=["learner", "n", "net"])


def _encoded(slim: DataFrame, model: Model, learners: int) -> DataFrame:
    """(learner, part, h, turn, ids): the ids of every text and its end, and the learner
    and round it is dealt to by a hash of id and text. `turn` tells equal rows of a batch
    apart, so that many of them do not crowd one learner."""
    shared = slim.sparkSession.sparkContext.broadcast(model.words[: model.shape.head])
    shape = model.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            flat, offsets = words(b.column("text"))
            ids = np.insert(_ids(flat, shared.value, shape)[0], offsets[1:], 0).astype(shape.id_type)  # an end after each text
            ends = offsets + np.arange(len(offsets))
            ids = [ids[i:j].tobytes() for i, j in zip(ends, ends[1:])]
            h = b.column("h").to_numpy()
            order = np.argsort(h, kind="stable")
            first = np.diff(h[order], prepend=h[order[0]] ^ 1) != 0
            turn = np.empty(len(h), np.int64)
            turn[order] = np.arange(len(h)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(turn), pa.array(ids, pa.binary())], ["h", "turn", "ids"])

    found = slim.select("text", F.xxhash64("doc_id", "text").alias("h")).mapInArrow(run, "h long, turn long, ids binary")
    dealt = F.xxhash64("h", "turn")
    return found.withColumns({"learner": F.pmod(dealt, F.lit(learners)), "part": F.pmod(F.shiftright(dealt, 32), F.lit(ROUNDS))})


def _train(slim: DataFrame, model: Model) -> dict:
    """In each round every learner, a task of its own, goes over its texts of that
    round, from the average of all learners of the round before; in all rounds together over each text once."""
    learners = max(LEARNERS, -(-model.tokens // LEARNER_TOKENS))
    dealt = materialize(_encoded(slim, model, learners), "lm-ids")
    shape, net = model.shape, model.net
    sc = slim.sparkSession.sparkContext
    schema = "learner long, n long, net binary"
    for turn in range(ROUNDS):
        learn = _learner(sc.broadcast(net), shape, RATE / (1 + turn))
        mine = dealt.where(F.col("part") == turn).drop("part").repartitionById(learners, F.col("learner").cast("int"))
        nets = materialize(mine.mapInArrow(learn, schema), "lm-nets")
        left = learners
        while left > 1:
            left = -(-left // FAN_IN)
            up = nets.withColumn("up", F.floor(F.col("learner") / FAN_IN).cast("long"))
            nets = materialize(up.groupBy("up").applyInArrow(_average, schema), "lm-nets")
        for r in nets.collect():  # one network, or none without rows
            net = pickle.loads(r["net"])
    return net


def score_documents(docs: DataFrame, model: Model, counts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every
    row: log10 probabilities of the whole text and its end, by word frequencies
    alone and by the network.

    The network gives a class of rarer words; a word's share of its class is its
    count plus 0.5, and unknown words of a class share 0.5. So the model's
    probabilities add up to 1 over all words and the unknown. Counts of words
    that do not travel with the model are joined; those words are rare, so no
    key is crowded. Null texts are empty: an end only. Null and repeated ids are
    rows like others; other columns are not looked at."""
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = Shared(docs.sparkSession, model)  # COUNTED words and a network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, rows = shared.value, 0
        first = TaskContext.get().partitionId() << 40
        norm = np.log10(m.tokens + 0.5 * (m.distinct + 1))
        logs = np.append(np.log10(m.counts + 0.5), 0.0)  # 0 for what is joined later
        names = ["key", "doc_id", "n_tokens", "n_known", "base", "score", "word"]
        for b in chunks(batches, "text", SCORE_BYTES):
            n = b.num_rows
            keys = first + rows + np.arange(n)
            rows += n
            flat, offsets = words(b.column("text"))
            ids, at = _ids(flat, m.words, m.shape)
            rare = ids > m.shape.head
            sums = logs[at]
            base = segment_sums(sums - norm, offsets) + np.log10(m.texts + 0.5) - norm
            inside = np.where(rare, sums - np.log10(np.append(m.mass, 1.0))[np.where(rare, ids - m.shape.head - 1, -1)], 0.0)
            score = gru.score_texts(m.net, m.shape, ids, offsets, WINDOW) / np.log(10) + segment_sums(inside, offsets)
            known = segment_sums((at >= 0).astype(float), offsets).astype(np.int64) + (m.texts > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), b.column("doc_id"), pa.array(np.diff(offsets) + 1), pa.array(known), pa.array(base), pa.array(score), pa.nulls(n, pa.string())],
                names=names,
            )
            absent = at < 0
            owner = np.repeat(keys, np.diff(offsets))[absent]
            k = len(owner)
            none = [pa.nulls(k, b.schema.field("doc_id").type), *(pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array(owner), *none, flat.filter(pa.array(absent)).cast(pa.string())], names=names)

    schema = f"key long, doc_id {kind}, n_tokens long, n_known long, base double, score double, word string"
    scored = materialize(slim.mapInArrow(run, schema), "lm-scores")
    absent = scored.where("word is not null").select("key", "word").join(counts, "word", "left")
    later = absent.groupBy("key").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log"), F.count("c").alias("known")
    )
    out = scored.where("word is null").drop("word").join(later, "key", "left")
    more = F.coalesce("log", F.lit(0.0))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
