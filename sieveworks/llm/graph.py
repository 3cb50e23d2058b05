"""Connected components of a graph of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import materialise


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Large star and small star alternate until nothing changes: a number of rounds that grows with the logarithm of the
    longest chain. Minima are aggregated before the shuffle, so a node with very many neighbours is no hot task. An edge
    with NULL connects nothing; repeated edges and loops change nothing; no edges give no nodes.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state = materialise(both)
    mark = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node goes to the node's smallest neighbour (or itself)
        sym = state.select("a", "b").union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = sym.join(low, F.col("a") == F.col("n")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller or equal neighbour goes to the smallest
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n"))
        state = materialise(
            small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        )
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    else:
        raise RuntimeError("components didn't converge")
    low = state.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return low.union(state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
