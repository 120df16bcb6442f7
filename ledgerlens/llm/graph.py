"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge here has a > b
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of the edges (columns a, b; longs),
    root being the component's smallest node.

    Each step reduces a node's neighbours to their minimum by a partial
    aggregate and joins it back, so no neighbour list is ever gathered; a node
    with very many edges is a hot join key that AQE splits.  Each round is
    written to the checkpoint folder.  O(log^2 n) rounds.
    """
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, last = durable(oriented), None
    for _ in range(max_rounds):
        now = state.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == last:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        last = now
        state = durable(_small_star(_large_star(state)))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
