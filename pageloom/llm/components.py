"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.session import written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u")
    return tied.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").union(
        least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with an edge to another; the component is its smallest node.

    ``edges`` has two long columns. Each round keeps the components, never has more edges than before by
    more than one for each node, and is written to the shared folder, so plans stay short and a lost
    executor costs one round. Rounds grow with the logarithm of the longest chain. Joins on a node with
    very many edges are split by adaptive execution; only counts and sums reach the driver."""
    now = written(edges.toDF("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        # a wrapping sum of hashes tells whether the set of edges has changed
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a))")).first()
        if tuple(state) == before:
            return now.toDF("node", "component").union(now.select("b", "b").distinct())
        before = tuple(state)
        now = written(_small(_large(now).distinct()).distinct(), "edges")
