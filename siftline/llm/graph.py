"""Connected components by alternating stars, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them. Edges go from the larger node a to b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it is linked to.

    Self-loops, nulls and repeated edges are allowed. Each round is written to the shared folder,
    so lineage stays short; a hub's edges are joined by its key, which adaptive execution splits.
    """
    forward = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    state, before = written(forward.distinct(), "edges"), None
    while True:
        large = _large_star(state).where("a > b").distinct()
        state = written(_small_star(large).where("a > b").distinct(), "edges")
        # The edges are all stars once a round changes nothing.
        now = state.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(state.select("b", "b").distinct())
