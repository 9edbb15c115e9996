"""Connected components of an undirected edge table, all in DataFrame joins.

Alternating large-star and small-star rounds: every node hands its larger
(then its smaller) neighbours to the least node it knows. Edges stay as many as
they were or fewer, so one node with very many links costs no more than its
links. Each round is a stored table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round over (a, b) with a > b, as distinct (a, b) with a > b."""
    if large:
        # All neighbours of each node, the smaller and the larger ones.
        near = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    else:
        near = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    least = near.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    joined = near.join(least, "node")
    moved = joined.where(F.col("other") > F.col("node")) if large else joined
    out = moved.select(F.col("other").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge to another node; the
    component is its least node. Nulls, loops and repeated edges are ignored."""
    now = materialise(edges.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
        if state == before:
            break
        before = state
        now = materialise(_star(materialise(_star(now, True)), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
