"""Mixing sources to target weights, by pivotal rounding of copy numbers.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafline.llm.text import uniform, word_count
from leafline.session import broadcast_if_small, materialize

#: weights of the sources in order, over and over
WEIGHTS = (5, 2, 1)
#: all targets together, as a share of all sizes; a source's target, times its size, at most
SHARE, MOST = 1.5, 2.0
#: rows that are folded together at a time, on average
FAN_IN = 64
#: a document of more than this share of its source is rounded before the others
BIG = 0.01


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n, source_size, target) from rows (source, size). Sources in
    code point order, null last, have the weights over and over. Targets are
    proportional to them up to `most` times a source's size; what is beyond is
    shared out by weight again. That is the one level at which `min(most * size,
    level * weight)` adds up to `share` of all sizes, found with running sums
    over the sources in the order in which they fill up."""
    if share > most:
        raise ValueError("share must not be above most")
    sums = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1  # one row per source
    ws = F.array(*[F.lit(float(w)) for w in weights])
    t = sums.withColumn("w", F.get(ws, place % len(weights))).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = (share * F.sum("source_size").over(everything) - run("cap")) / (F.sum("w").over(everything) - run("w"))
    t = t.withColumn("at", F.row_number().over(fill)).withColumn("level", level)
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("at", "level"))).over(everything)["level"]
    return t.withColumn("level", first).select(
        "source", "n", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("w")), "cap").alias("target")
    )


def _fold(rows: DataFrame) -> DataFrame:
    """(source, o, c): the rows (source, chunk, h, d, s, p, u) of each chunk folded
    from left to right: c is the one row whose p may still be fractional, o has
    the others with their decision k. Of two rows, mass p * s moves to one or the
    other until a p is 0 or 1; which way is drawn so that neither p changes on
    average, and the sum of p * s never changes at all."""
    d = rows.schema["d"].dataType.simpleString()
    item = f"struct<h: bigint, d: {d}, s: double, p: double, u: double>"
    done = f"array<struct<d: {d}, k: int>>"
    moved = lambda x, p: f"named_struct('h', {x}.h, 'd', {x}.d, 's', {x}.s, 'p', {p}, 'u', {x}.u)"
    decided = lambda x, k: f"array_append(st.o, named_struct('d', {x}.d, 'k', {k}))"
    state = lambda c, o: f"named_struct('c', {c}, 'o', {o})"
    step = f"""CASE WHEN st.c IS NULL THEN {state('x', 'st.o')} ELSE
      transform(array(named_struct('up', least((1 - st.c.p) * st.c.s, x.p * x.s), 'down', least(st.c.p * st.c.s, (1 - x.p) * x.s))), m ->
        CASE WHEN x.u * (m.up + m.down) < m.down
          THEN CASE WHEN (1 - st.c.p) * st.c.s <= x.p * x.s
            THEN {state(moved('x', 'greatest(0D, x.p - m.up / x.s)'), decided('st.c', 1))}
            ELSE {state(moved('st.c', 'least(1D, st.c.p + m.up / st.c.s)'), decided('x', 0))} END
          ELSE CASE WHEN st.c.p * st.c.s <= (1 - x.p) * x.s
            THEN {state(moved('x', 'least(1D, x.p + m.down / x.s)'), decided('st.c', 0))}
            ELSE {state(moved('st.c', 'greatest(0D, st.c.p - m.down / st.c.s)'), decided('x', 1))} END
        END)[0] END"""
    start = state(f"CAST(NULL AS {item})", f"CAST(array() AS {done})")
    items = rows.groupBy("source", "chunk").agg(F.array_sort(F.collect_list(F.struct("h", "d", "s", "p", "u"))).alias("items"))
    return items.select("source", F.expr(f"aggregate(items, {start}, (st, x) -> {step})").alias("st")).select(
        "source", F.col("st.o").alias("o"), F.col("st.c").alias("c")
    )


def _decided(folded: DataFrame) -> DataFrame:
    return folded.select(F.explode("o").alias("x")).select("x.d", "x.k")


def copy_numbers(sized: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, h, source_size, target, copies) of rows (doc_id,
    source, size, h). Each source's `copies * size` add up to its target within
    one of its documents of BIG of its size or less, unless it has larger ones only.

    All rows of a source have target / size copies on average. The whole part is
    given to all; the fractional part is rounded by pairs. Large documents go
    first, and the last of them is settled against all the small ones at once,
    whose share moves a little. Then chunks of rows, chosen by hash, are folded
    side by side, the one row left of each chunk goes to the next round, and so
    on until a source has one row left, which is drawn. A chunk has about FAN_IN
    rows however large its source is."""
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sides = materialize(targets.withColumn("r", share).withColumn("p", F.col("r") - F.floor("r")), "mix-targets")
    sides = broadcast_if_small(sides.select(F.col("source").alias("__s"), F.col("n").alias("__n"), "source_size", "target", "r", "p"))
    rows = sized.join(sides, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    d = F.struct("doc_id", "source", "size", "h", "source_size", "target", F.floor("r").cast("int").alias("base"))
    draw = lambda salt: uniform(F.col("h"), F.lit(seed), F.lit(salt))
    rows = rows.select(
        "source", "h", d.alias("d"), F.col("size").cast("double").alias("s"), "p", draw(0).alias("u"), F.col("__n").alias("n"),
        ((F.col("p") > 0) & (F.col("size") > 0)).alias("open"), (F.col("size") > BIG * F.col("source_size")).alias("big"),
    )
    rows = materialize(rows, "mix-rows")
    out = [rows.where("not open").select("d", F.lit(0).alias("k"))]
    big = materialize(_fold(rows.where("open and big").withColumn("chunk", F.lit(0))), "mix-big")
    out.append(_decided(big))
    # the last large row of a source against its pool of small ones
    pool = rows.where("open and not big").groupBy("source").agg(F.sum("s").alias("m"), F.first("p").alias("q"))
    pool = pool.withColumnRenamed("source", "__s")
    last = big.join(pool, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s").select("source", "c", F.coalesce("m", F.lit(0.0)).alias("m"), "q")
    last = last.withColumns({"q": F.coalesce("q", F.lit(0.0)), "cm": F.col("c.p") * F.col("c.s"), "cr": (1 - F.col("c.p")) * F.col("c.s")})
    last = last.withColumns({"up": F.least("cr", F.col("q") * F.col("m")), "down": F.least("cm", (1 - F.col("q")) * F.col("m"))})
    last = last.withColumn("rises", uniform(F.col("c.h"), F.lit(seed), F.lit(1)) * (F.col("up") + F.col("down")) < F.col("down"))
    gain = F.when(F.col("rises"), F.col("up")).otherwise(-F.col("down"))
    last = last.withColumn("gain", gain).select(
        "source", "c", F.when(F.col("m") > 0, F.col("q") - F.col("gain") / F.col("m")).alias("q"),
        F.when(F.col("rises") & (F.col("cr") <= F.col("q") * F.col("m")), 1.0)
        .when(~F.col("rises") & (F.col("cm") <= (1 - F.col("q")) * F.col("m")), 0.0)
        .otherwise((F.col("cm") + F.col("gain")) / F.col("c.s")).alias("cp"),
    )
    last = materialize(last, "mix-last")
    settled = F.col("cp").isin(0.0, 1.0)
    out.append(last.where(settled).select(F.col("c.d").alias("d"), F.col("cp").cast("int").alias("k")))
    shifted = broadcast_if_small(last.where("q is not null").select(F.col("source").alias("__s"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), "q")).alias("__q")))
    small = rows.where("open and not big").join(shifted, F.col("source").eqNullSafe(F.col("__s")), "left")
    small = small.select("source", "h", "d", "s", F.coalesce("__q", "p").alias("p"), "u", "n")
    stuck = last.where(~settled).select("source", "c.h", "c.d", "c.s", F.col("cp").alias("p"), "c.u", F.lit(1).cast("long").alias("n"))
    level = small.unionByName(stuck)
    most = rows.agg(F.max("n")).first()[0] or 0
    chunks, salt = F.col("n"), 2
    while True:
        most = -(-most // FAN_IN)
        chunks = F.ceil(F.col("n") / FAN_IN).cast("long")
        level = level.withColumn("chunk", F.pmod(F.xxhash64("h", F.lit(seed), F.lit(salt)), F.greatest(chunks, F.lit(1))))
        folded = materialize(_fold(level), "mix-level")
        out.append(_decided(folded))
        salt += 1
        if most <= 1:
            break
        # as many rows as there were chunks, counted anew as a chunk may have been empty
        left = folded.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "__s")
        level = folded.join(broadcast_if_small(left), F.col("source").eqNullSafe(F.col("__s"))).select(
            "source", "c.h", "c.d", "c.s", "c.p", uniform(F.col("c.h"), F.lit(seed), F.lit(salt)).alias("u"), "n"
        )
    # rounded, not drawn: a source misses its target by half of its last row at most
    final = F.col("c.p") >= 0.5
    out.append(folded.select(F.col("c.d").alias("d"), final.cast("int").alias("k")))
    return reduce(DataFrame.unionByName, out).select("d.*", "k").select(
        "doc_id", "source", "size", "h", "source_size", "target", (F.col("base") + F.col("k")).alias("copies")
    )


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(doc_id), F.col(text), F.col(source)).alias("h"),
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """(doc_id, source, size, h, source_size, target, copies, taken) for every
    row: how often the mix takes the document, and how many words that is.

    Sizes are words; null and empty texts have size 0 and take nothing. A null
    source is a source, the last. Draws depend on ids, texts and sources only, so
    reruns agree; rows that are equal in all of them are drawn one by one but
    in the same chunk. No rows give no rows."""
    sized = materialize(_sized(docs, doc_id, text, source), "mix-sizes")
    out = copy_numbers(sized, source_targets(sized), seed)
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def take_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The rows of `docs`, each as often as `mix` takes it, with the columns of `docs`."""
    key = F.xxhash64(F.col(doc_id), F.col(text), F.col(source))
    drawn = mix(docs, doc_id, text, source, seed).select(F.col("h").alias("__h"), F.col("copies").alias("__copies"))
    turn = lambda *order: F.row_number().over(Window.partitionBy("__h").orderBy(*order))
    drawn = drawn.withColumn("__turn", turn("__copies"))
    rows = docs.withColumn("__h", key).withColumn("__turn", turn(F.col(doc_id)))
    taken = rows.join(drawn.where("__copies > 0"), ["__h", "__turn"])
    return taken.withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[f"`{c}`" for c in docs.columns])
