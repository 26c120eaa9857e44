"""Connected components by alternating star steps: every round is a few shuffled joins over the
edges, and no component is ever held in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "a")).alias("y"),
    ).first()
    return tuple(row)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: a, b (long). Returns node, label: the smallest node that can be reached, for every
    node of an edge. No edges: no rows. Each round writes its edges to the shared folder."""
    edges = saved(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        # Neighbours above a node move to the smallest node around it.
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).unionAll(
            edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            join_hot(both, least, ["u"])
            .filter("v > u")
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
            .distinct()
        )
        # Neighbours below a node, and the node itself, move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_hot(large, least, ["a"])
        edges = saved(
            small.select("a", F.col("m").alias("b"))
            .unionAll(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
