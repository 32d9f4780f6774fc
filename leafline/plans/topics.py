"""Up to three topic words per title."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators import title_words as T
from leafline.session import materialize

NUM_TOPICS = 5
WORDS = 3
# full passes over all comments
ITERATIONS = 10
# several models are begun at random and the likeliest goes on alone for the last passes
STARTS = 3
LAST_ALONE = 3
# rounds in which a comment's topic shares are found, given the words' weights
INNER = 3
# priors: of a topic in a comment, and of a word in a topic
ALPHA, BETA = 0.1, 1.0
# parts of one that weights are counted in, so that sums are exact
PARTS = 1 << 20
# words of the bags that one task reads at once; small inputs are still cut for a few tasks
BLOCK_WORDS, SMALL_BLOCK, FEW = 1 << 20, 1 << 14, 8
# words of a block that are worked on at a time, so that its numbers stay in a core's cache
STEP_WORDS = 1 << 15
BAG_KEY = ("d1", "d2")


def bag_key() -> list[Column]:
    """96 bits that tell bags apart."""
    return [F.xxhash64("bag").alias("d1"), F.hash("bag").alias("d2")]


def _bags(kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bags, needs): each distinct bag once, with its number of comments, in blocks
    of about BLOCK_WORDS words; and the words that each block has. A bag names its
    words by their places among its block's words in order, found once for all passes."""
    once = kept.groupBy(*bag_key()).agg(F.any_value("bag").alias("bag"), F.count(F.lit(1)).alias("m"))
    words = F.transform("bag", lambda x: F.xxhash64(x.term))
    counts = F.transform("bag", lambda x: x.n.cast("float"))
    once = materialize(once.select(*BAG_KEY, "m", words.alias("w"), counts.alias("n")), "bags")
    total = once.agg(F.sum(F.size("w"))).first()[0]
    blocks = max(-(-total // BLOCK_WORDS), min(FEW, -(-total // SMALL_BLOCK)))
    in_blocks = once.withColumn("block", F.pmod("d1", F.lit(blocks))).groupBy("block")
    schema = "block long, d1 long, d2 int, m long, at array<int>, n array<float>, words array<long>"
    placed = materialize(in_blocks.applyInArrow(_places(), schema), "blocks")
    needs = placed.where("words IS NOT NULL").select("block", F.explode("words").alias("w"))
    return placed.where("words IS NULL").drop("words"), materialize(needs, "block-words")


def _places() -> Callable:
    """The bags of a block with their words' places, and one row with its words in order."""

    def run(bags):
        import numpy as np
        import pyarrow as pa

        bags = bags.combine_chunks()
        w = bags["w"].chunk(0)
        words, at = np.unique(w.flatten().to_numpy(), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(w.value_lengths().to_numpy())])
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at.ravel().astype(np.int32)))
        cols = {c: bags[c].chunk(0) for c in ("block", "d1", "d2", "m")} | {"at": lists, "n": bags["n"].chunk(0)}
        rows = {c: pa.concat_arrays([v, pa.nulls(1, v.type)]) for c, v in cols.items()}
        rows["block"] = pa.concat_arrays([cols["block"], cols["block"][:1]])
        return pa.table(rows | {"words": pa.array([None] * len(w) + [words], pa.list_(pa.int64()))})

    return run


def _pass(totals: list[list[float]], n_words: int, shares: bool) -> Callable:
    """What a block does, from its bags and their words' weights `s`, one after the
    other for each start and topic: topic shares of each bag, then either those, or
    the sums of topic shares for each word. A row without a word holds the
    log-likelihood of each start, at the start's first topic."""
    alpha, beta, inner, parts, step = ALPHA, BETA, INNER, PARTS, STEP_WORDS

    def run(bags, words):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        k = len(totals[0])
        size = pc.list_value_length(bags["at"]).to_numpy()
        ends = np.cumsum(size, dtype=np.int64)
        at = np.concatenate([c.flatten().to_numpy() for c in bags["at"].chunks])
        n = np.concatenate([c.flatten().to_numpy() for c in bags["n"].chunks])
        ids = words["w"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        weights = np.concatenate([c.flatten().to_numpy() for c in words["s"].chunks]).reshape(len(ids), -1)[order].T
        times = np.repeat(bags["m"].to_numpy(), size) * n.astype(float)
        cuts = [0]
        while cuts[-1] < len(size):
            done = ends[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + step, side="right"))))
        all_shares = np.empty((k, len(size)), dtype=np.float32)
        sums = np.zeros((len(weights), len(ids) + 1), dtype=np.int64)
        counted = np.empty((k, len(at)))
        for start, total in enumerate(totals):
            own = slice(start * k, start * k + k)
            by_word = ((weights[own] + beta) / (np.array(total)[:, None] + beta * n_words) * n_words).astype(np.float32)
            for b, e in zip(cuts, cuts[1:]):
                of = slice(ends[b] - size[b], ends[e - 1])
                begin, length = ends[b:e] - size[b:e] - of.start, size[b:e]
                p = by_word[:, at[of]]
                share = np.full((k, e - b), 1.0 / k, dtype=np.float32)
                for _ in range(inner):
                    part = np.repeat(share, length, axis=1) * p
                    part /= part.sum(axis=0)
                    share = np.add.reduceat(part * n[of], begin, axis=1) + alpha
                    share /= share.sum(axis=0)
                if shares:
                    all_shares[:, b:e] = share
                    continue
                likely = np.log((np.repeat(share, length, axis=1) * p).sum(axis=0))
                np.rint(part * (times[of] * parts), out=counted[:, of])
                sums[own.start, -1] += int(np.rint(likely * (times[of] * parts)).sum())
            if shares:
                flat = all_shares.T.ravel().astype(float)
                rows = pa.FixedSizeListArray.from_arrays(flat, k).cast(pa.list_(pa.float64()))
                return pa.table({"d1": bags["d1"], "d2": bags["d2"], "share": rows})
            for i in range(k):
                sums[own.start + i, :-1] = np.bincount(at, weights=counted[i], minlength=len(ids))
        columns = {"w": pa.concat_arrays([pa.array(ids), pa.nulls(1, pa.int64())])}
        return pa.table(columns | {f"s{i}": c for i, c in enumerate(sums)})

    return run


def _in_blocks(bags: DataFrame, weights: DataFrame, totals: list[list[float]], n_words: int, schema: str, shares: bool = False) -> DataFrame:
    both = bags.groupBy("block").cogroup(weights.groupBy("block"))
    return both.applyInArrow(_pass(totals, n_words, shares), schema)


def fit(
    kept: DataFrame, k: int = NUM_TOPICS, iterations: int = ITERATIONS, seed: int = 0, starts: int = STARTS
) -> tuple[DataFrame, DataFrame]:
    """(weights, shares) of one topic model over the bags of all comments `kept`:
    each word's weight in each topic (w, weights), w being the word's xxhash64,
    and the topic shares of each distinct bag (d1, d2, share).

    Expectation maximisation. Weights are a table by word: in each pass every block of
    bags is handed the weights of its own words, finds the shares of its bags and gives back a
    sum per word. So no word shares a weight with another and no task or
    driver holds the whole vocabulary. `starts` models run side by side until the
    likeliest is taken for the last passes. Weights are sums of whole numbers:
    neither the order of rows nor a task run twice changes them."""
    bags, needs = _bags(kept)
    n_words = needs.select("w").distinct().count()

    def at_random(i: int) -> Column:
        u = (F.pmod(F.xxhash64("w", F.lit(seed), F.lit(i)), F.lit(PARTS)) + 1) / (PARTS + 1)
        return -F.log(u)

    weights = needs.select("block", "w", F.array(*[at_random(i) for i in range(k * starts)]).alias("s"))
    totals = [[float(n_words)] * k] * starts
    table = None
    for i in range(max(1, iterations)):
        cols = [f"s{j}" for j in range(k * len(totals))]
        found = _in_blocks(bags, weights, totals, n_words, "w long, " + ", ".join(f"{c} long" for c in cols))
        table = materialize(found.groupBy("w").agg(*[F.sum(c).alias(c) for c in cols]), "word-topics")
        word = F.col("w").isNotNull()
        sums = table.groupBy(word.alias("word")).agg(*[F.sum(c).alias(c) for c in cols]).collect()
        of_words = next(r for r in sums if r["word"])
        likely = next(r for r in sums if not r["word"])
        totals = [[of_words[f"s{s * k + j}"] / PARTS for j in range(k)] for s in range(len(totals))]
        first = 0
        if len(totals) > 1 and i + 1 >= iterations - LAST_ALONE:
            best = max(range(len(totals)), key=lambda s: (likely[f"s{s * k}"], -s))
            first, totals = best * k, [totals[best]]
        kept_cols = cols[first : first + k * len(totals)]
        table = table.where(word).select("w", F.array(*[F.col(c) / PARTS for c in kept_cols]).alias("s"))
        weights = needs.join(table, "w").select("block", "w", "s")
    schema = "d1 long, d2 int, share array<double>"
    shares = materialize(_in_blocks(bags, weights, totals, n_words, schema, shares=True), "bag-shares")
    return table.withColumnRenamed("s", "weights"), shares


def _in_topic_order(entries: list[Column], n_words: int) -> Column:
    """Words of (order, term) structs: sorted, distinct, the first `n_words`."""
    words = F.transform(F.sort_array(F.array(*entries)), lambda e: e.term)
    return F.slice(F.array_distinct(F.filter(words, lambda w: w.isNotNull())), 1, n_words)


def topic_readout(dtm: DataFrame, terms: DataFrame, shares: DataFrame, num_topics: int, n_words: int = WORDS) -> DataFrame:
    """(t_id, t_topics) from a title's words (t_id, term, n), the words' weights in
    each topic (term, weights) and the topic shares of its comments (t_id, share, m),
    m being the number of comments with the same bag.

    A title's topics come in order of their mean share in its comments; each gives
    the title's own word with the largest topic weight x lift, lift being the
    word's share in the title over its share in the corpus."""
    total = F.sum("m")
    mean = shares.groupBy("t_id").agg(*[(F.sum(F.col("share")[i] * F.col("m")) / total).alias(f"m{i}") for i in range(num_topics)])
    title_tf = dtm.groupBy("t_id", "term").agg(F.sum("n").alias("tf"))
    corpus = title_tf.groupBy("term").agg(F.sum("tf").alias("all_tf")).join(terms, "term")
    # totals of title and corpus are the same for all words of a title: left out
    lift = F.col("tf") / F.col("all_tf")
    best = title_tf.join(corpus, "term").groupBy("t_id").agg(
        *[
            F.min(F.struct((-(F.col("weights")[i] * lift)).alias("score"), F.col("term"))).alias(f"b{i}")
            for i in range(num_topics)
        ]
    )
    entries = [
        F.struct((-F.col(f"m{i}")).alias("share"), F.lit(i).alias("topic"), F.col(f"b{i}.term").alias("term"))
        for i in range(num_topics)
    ]
    return best.join(mean, "t_id").select("t_id", _in_topic_order(entries, n_words).alias("t_topics"))


def title_topics(
    comments: DataFrame,
    num_topics: int = NUM_TOPICS,
    n_words: int = WORDS,
    iterations: int = ITERATIONS,
    seed: int = 0,
    tokens: str | None = None,
    starts: int = STARTS,
) -> DataFrame:
    """(t_id, t_topics) from one model over the comments of all titles. A title
    without kept words has no row (`skipped_titles` lists them)."""
    docs = materialize(T.title_documents(comments, tokens), "title-documents")
    kept = materialize(T.keep_terms(docs, T.dropped_terms(docs)).where(F.size("bag") > 0), "title-words")
    spark = comments.sparkSession
    if kept.isEmpty():
        return spark.createDataFrame([], "t_id string, t_topics array<string>")
    weights, shares = fit(kept, num_topics, iterations, seed, starts)
    dtm = T.words_of(kept, ("t_id",))
    terms = dtm.select("term").distinct().withColumn("w", F.xxhash64("term")).join(weights, "w").select("term", "weights")
    by_title = kept.groupBy("t_id", *bag_key()).agg(F.count(F.lit(1)).alias("m")).join(shares, [*BAG_KEY])
    return topic_readout(dtm, terms, by_title, num_topics, n_words)


def topic_items(topics: DataFrame) -> DataFrame:
    """Topics in the stored table's column names."""
    return topics.select(F.col("t_id").alias("t_index"), "t_topics")
