"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Join every neighbour of a node to the least of them and itself: the
    neighbours above the node (large) or below it (small)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # edges have a > b, so a node's lower neighbours are its rows as `a`
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    told = both.join(least, "a")
    if large:
        out = told.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = told.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), where root is the least
    node that can be reached. Rounds grow with the logarithm of the number of
    nodes; each is written to the shared folder. Loops and repeated edges do no
    harm; no edges give no rows."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = materialize(now, "edges"), None
    while True:
        now = materialize(_star(_star(now, True), False), "stars")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
