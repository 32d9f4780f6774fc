"""The comments most like each of many reviews, exactly, without scoring all pairs.

A first pass scores the comments that hold a rare word of the review; the least of
the scores asked for is then a threshold. Words of the review that cannot
reach it between them (their weights' length is below it, and a comment's vector has
length one) need no look-up: a second pass takes the comments that hold one of
the other words. A lower bound of their length that holds for all titles' models
tells which may reach the threshold; only those are scored in the model of the title.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators import title_models as M
from leafline.operators import vectors as V
from leafline.operators.ranking import ranked
from leafline.session import BROADCAST_BYTES, materialize

# scores within rounding of the threshold are looked at
SLACK = 1e-8
# buckets of reviews that rounds are packed from
_BUCKETS = 1024
ORDER = ("t_id", "comment_pos", "comment_key", "copy")


def review_words(reviews: DataFrame, fitted: M.Fitted, per_title: bool) -> DataFrame:
    """(rid, user_id, user_t_id, model_t, n_docs, dropped, enough, words) of each review: its words in
    its title's model as structs id, q, qi, df, the rarest first. q is the
    review's unit vector, qi is q times the word's weight, df the number of comments of
    other titles that hold the word."""
    model_of = F.col("t_id") if per_title else F.lit(None).cast("string")
    asked = reviews.select(
        F.monotonically_increasing_id().alias("rid"), "user_id", F.col("t_id").alias("user_t_id"), model_of.alias("model_t"), "words"
    )
    models = fitted.models.select(F.col("t_id").alias("m"), "n_docs", "idf", "dropped", "enough")
    rows = fitted.base.counts(asked).join(models, F.col("model_t").eqNullSafe(F.col("m")))
    rows = rows.withColumn("c", M.numbers("counts")).withColumn("w", M.weights(F.col("c"), F.col("idf")))
    rows = rows.withColumn("norm", M.norm(F.col("w")))

    def word(i: Column, w: Column) -> Column:
        idf = F.get("idf", i)
        df = F.round((F.col("n_docs") + 1) / F.exp(idf - 1) - 1)
        q = F.try_divide(w, "norm")
        return F.struct(df.alias("df"), i.alias("id"), q.alias("q"), (q * idf).alias("qi"), w.alias("w"))

    words = F.sort_array(F.filter(F.zip_with("c.indices", "w", word), lambda x: x.w > 0))
    return rows.select("rid", "user_id", "user_t_id", "model_t", "n_docs", "dropped", "enough", words.alias("words"))


def review_rounds(asked: DataFrame, max_rows: int) -> tuple[list[tuple[Column, bool]], int, bool]:
    """Conditions that split the reviews into rounds of at most `max_rows` words
    and whether a round's may be broadcast; the number of reviews; and whether all
    models have looked at enough words."""
    bucket = F.pmod(F.xxhash64("rid"), F.lit(_BUCKETS))
    sizes = asked.groupBy(bucket.alias("b")).agg(
        F.sum(F.size("words")).alias("n"), F.count("*").alias("reviews"), F.min("enough").alias("enough")
    ).orderBy("b").collect()
    rounds: list[tuple[list[int], int]] = []
    for r in sizes:
        if rounds and rounds[-1][1] + r["n"] <= max_rows:
            rounds[-1] = (rounds[-1][0] + [r["b"]], rounds[-1][1] + r["n"])
        else:
            rounds.append(([r["b"]], r["n"]))
    found = [(bucket.isin(bs) if len(rounds) > 1 else F.lit(True), n <= max_rows) for bs, n in rounds]
    return found or [(F.lit(True), True)], sum(r["reviews"] for r in sizes), all(r["enough"] for r in sizes)


def _dot(words: Column, c: Column) -> Column:
    """Sum over the review's words of qi times the word's number in the comment."""
    number = lambda e: F.coalesce(F.get(c["values"], (F.array_position(c["indices"], e.id) - 1).cast("int")), F.lit(0.0))
    return F.aggregate(words, F.lit(0.0), lambda a, e: a + e.qi * number(e))


def _leading(words: Column, value: Callable[[Column], Column], more: Callable[[Column], Column]) -> Column:
    """The number of leading words as long as `more` holds for the running sum of
    `value` with the word's own."""
    none = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
    step = lambda s, e: F.struct((s.sum + value(e)).alias("sum"), (s.n + F.when(more(s.sum + value(e)), 1).otherwise(0)).alias("n"))
    return F.aggregate(words, none, step, lambda s: s.n)


def looked_at(rows: DataFrame, chosen: DataFrame, small: bool) -> DataFrame:
    """Each comment of `rows` beside each review of `chosen` that it holds a word in
    `sel` of, once: at the least such word; not those of the review's title."""
    words = chosen.select("rid", F.col("user_t_id").alias("own"), "sel", F.explode("sel").alias("id"))
    found = rows.withColumn("id", F.explode("c.indices")).join(F.broadcast(words) if small else words, "id")
    first = F.col("id") == F.array_min(F.array_intersect("c.indices", "sel"))
    found = found.where(first & _other()).drop("id", "sel", "own")
    side = chosen.drop("sel")
    return found.join(F.broadcast(side) if small else side, "rid")


def _other() -> Column:
    return F.col("own").isNull() | (F.col("t_id") != F.col("own"))


def within_reach(rows: DataFrame, chosen: DataFrame, small: bool) -> DataFrame:
    """Comments of `rows` (by cid) beside reviews of `chosen` that may reach the
    review's threshold. Only the review's `needed` words are looked up and summed (`dot`); its
    light words add `rest` at most. Comments with a word in `rare` are left
    out, and those of its title. A comment with a word that the title's model lacks may be
    shorter there than `core` says, and stays."""
    kinds = F.concat(
        F.transform("needed", lambda e: F.struct(e.id.alias("id"), e.qi.alias("qi"), F.lit(0).alias("kind"))),
        F.transform("rare", lambda i: F.struct(i.alias("id"), F.lit(0.0).alias("qi"), F.lit(1).alias("kind"))),
        F.transform("dropped", lambda i: F.struct(i.alias("id"), F.lit(0.0).alias("qi"), F.lit(2).alias("kind"))),
    )
    words = chosen.select("rid", F.col("user_t_id").alias("own"), F.inline(kinds))
    each = rows.select("cid", "t_id", "core", F.col("c.values").alias("ns"), F.posexplode("c.indices").alias("at", "id"))
    found = each.join(F.broadcast(words) if small else words, "id").where(_other())
    has = lambda k: F.max(F.col("kind") == k)
    sums = found.groupBy("cid", "core", "rid").agg(
        F.sum(F.col("qi") * F.get("ns", F.col("at"))).alias("dot"), has(0).alias("some"), has(1).alias("old"), has(2).alias("unsure")
    )
    side = chosen.drop("needed", "rare", "dropped")
    sums = sums.where(F.col("some") & ~F.col("old")).join(F.broadcast(side) if small else side, "rid")
    # leaving out a title takes at most log(all / others) from a weight, which is at least 1
    sums = sums.withColumn("known", F.when(~F.col("unsure"), F.col("core") * F.col("shrunk")).otherwise(0.0)).drop("core")
    return sums.where((F.col("known") <= 0) | (F.col("dot") + F.col("rest") * F.col("known") >= F.col("least") * F.col("known")))


def exact_scores(pairs: DataFrame, dot: Column) -> DataFrame:
    """Positive cosines of pairs of comment and review in the model of the
    review's title: columns c and idf, and the product of their vectors but for the comment's length."""
    score = F.try_divide(dot, M.norm(M.weights(F.col("c"), F.col("idf"))))
    scored = pairs.select("user_id", "user_t_id", *M.KEYS, "copies", F.round(score, V.RANK_DIGITS).alias("score"))
    return scored.where(F.col("score") > 0)


def _with_copies(scores: list[DataFrame], last: int) -> DataFrame:
    # a rank past `last` is never used, so neither is a further copy
    copies = F.sequence(F.lit(1), F.least(F.col("copies").cast("int"), F.lit(last)))
    return reduce(DataFrame.unionByName, scores).withColumn("copy", F.explode(copies)).drop("copies")


def most_similar(
    fitted: M.Fitted, asked: DataFrame, rounds: list[tuple[Column, bool]], n_reviews: int, max_terms: int, first: int, last: int
) -> DataFrame:
    """(user_id, user_t_id, KEYS, score, rank): the comments ranked first..last for
    each of `review_words`, positive cosines only.

    Comments are dealt out once, by comment, and everything up to their scores is
    local to the comment; pairs are never shuffled, only the best rows of each task
    and review. Reviews are broadcast in rounds whose size is counted, or
    joined without where one is too large."""
    spark = asked.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    models = fitted.models.select(F.col("t_id").alias("m"), "idf")
    if n_reviews * 8 * len(fitted.base.terms) <= BROADCAST_BYTES:  # there are no more titles than reviews
        models = F.broadcast(models)
    of_title = F.col("model_t").eqNullSafe(F.col("m"))
    order = [F.col("score").desc(), *map(F.col, ORDER)]
    ids = lambda words: F.transform(words, lambda e: e.id)
    by_id = lambda words: F.transform(words, lambda e: F.struct(e.id.alias("id"), e.qi.alias("qi")))
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(fitted.base.idf(max_terms)), inputCol="counts", outputCol="scaled")
    rows = scaled.transform(fitted.rows.repartition(tasks, "cid"))
    core = M.norm(M.numbers("scaled")["values"])
    rows = rows.select("cid", *M.KEYS, "copies", M.numbers("counts").alias("c"), core.alias("core"))

    # the first pass: the rarest words that lead to enough comments
    enough = F.least(_leading(F.col("words"), lambda e: e.df, lambda s: s < 2 * last) + 1, F.size("words"))
    asked = asked.withColumn("rare", F.slice(ids("words"), 1, enough)).drop("enough")
    who = ("rid", "user_id", "user_t_id", "model_t")
    chosen = asked.select(*who, by_id("words").alias("words"), F.col("rare").alias("sel"))
    pairs = [looked_at(rows.drop("core"), chosen.where(part), small).join(models, of_title) for part, small in rounds]
    scored = _with_copies([exact_scores(p, _dot(F.col("words"), F.col("c"))) for p in pairs], last)
    best = materialize(ranked(scored, ["user_id", "user_t_id"], order, 1, last), "first-pass")

    # the second: words that can lead to more, and comments that may then reach the threshold
    least = best.where(F.col("rank") == last).select(F.col("user_id").alias("u"), F.col("user_t_id").alias("t"), F.col("score").alias("least"))
    mine = F.col("user_id").eqNullSafe(F.col("u")) & F.col("user_t_id").eqNullSafe(F.col("t"))
    asked = asked.join(least, mine, "left").withColumn("least", F.coalesce("least", F.lit(0.0)) - SLACK)
    asked = asked.withColumn("words", F.array_sort(F.transform("words", lambda e: F.struct(e.q.alias("q"), e.id.alias("id"), e.qi.alias("qi")))))
    alone = _leading(F.col("words"), lambda e: e.q * e.q, lambda s: F.sqrt(s) < F.col("least"))
    asked = asked.withColumn("light", F.slice("words", 1, alone)).withColumn("heavy", F.slice("words", F.size("light") + 1, F.size("words")))
    asked = asked.withColumn("needed", F.filter("heavy", lambda e: ~F.array_contains("rare", e.id)))
    rest = F.sqrt(F.aggregate("light", F.lit(0.0), lambda a, e: a + e.q * e.q))
    shrunk = 1 - F.log((F.lit(float(fitted.base.n_docs)) + 1) / (F.col("n_docs") + 1))
    chosen = asked.select(
        *who, by_id("needed").alias("needed"), "rare", "dropped", by_id("light").alias("light"), rest.alias("rest"), shrunk.alias("shrunk"), "least",
    ).where(F.size("needed") > 0)
    pairs = []
    for part, small in rounds:
        near = within_reach(rows, chosen.where(part), small).join(rows.drop("core"), "cid")
        near = near.withColumn("dot", F.col("dot") + _dot(F.col("light"), F.col("c")))
        near = near.where((F.col("known") <= 0) | (F.col("dot") >= F.col("least") * F.col("known")))
        pairs.append(near.join(models, of_title))
    both = best.drop("rank").unionByName(_with_copies([exact_scores(p, F.col("dot")) for p in pairs], last))
    hits = ranked(both, ["user_id", "user_t_id"], order, first, last)
    return hits.select("user_id", "user_t_id", *M.KEYS, "score", "rank")
