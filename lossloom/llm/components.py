"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps on the edge table: each step is one combining
    aggregate and one join, no group is ever gathered, and the number of rounds grows with the
    logarithm of the nodes. Edges of a hub meet in a plain sort-merge join, which adaptive
    execution splits. Every round is stored, so a lost executor costs one round at most.
    Self-loops are ignored; an empty table gives no rows.
    """
    links = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(links)
    while True:
        links = stored(small_star(large_star(links)))
        now = mark(links)
        if now == before:
            break
        before = now
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))
                              .distinct())


def mark(links: DataFrame) -> tuple:
    """Number of edges and an order-free checksum."""
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def large_star(links: DataFrame) -> DataFrame:
    """Links of larger neighbours move to the smallest neighbour (or the node itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                        F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """The node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()
