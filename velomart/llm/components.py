"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregation and one join over the edges, written below the shared folder, so
no lineage grows and no task holds a component. A node with very many neighbours is one key of
a sort-merge join, which adaptive execution splits; its minimum is aggregated before the
shuffle. The number of steps grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.workspace import materialize


def _stored_least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node; stored, so that the join with it can be split."""
    return materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _stored_least(both)
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = _stored_least(edges)
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    ).first()
    return row.n, row.x or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not the least of its component.

    The root is the least node reachable. Self-loops, repeated edges and nulls are allowed and
    mean nothing; an empty edge table gives an empty result.
    """
    edges = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _state(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
