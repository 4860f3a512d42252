"""Connected components of an edge list, by alternating star steps.

Each round is a few joins and groupings on node ids.  Neighbourhoods are never
collected: a step only needs each node's smallest neighbour and a join with it,
both salted, so that a node with very many neighbours is no task's alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, salt


def _with_smallest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each edge with ``m``, the smallest ``b`` of its ``a``; and ``(a, m)`` alone.

    The edges of a hub spread over salts, each of which gets the hub's smallest.
    """
    salted = edges.withColumn("salt", salt(F.col("b")))
    some = salted.groupBy("a", "salt").agg(F.min("b").alias("m"))
    low = some.groupBy("a").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))
    spread = low.select("a", "m", F.explode("salts").alias("salt"))
    return salted.join(spread, ["a", "salt"]).drop("salt"), low.drop("salts")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of the node's neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = _with_smallest(both)
    return joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    joined, low = _with_smallest(down)
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b"))


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for each node of an edge; ``root`` is the smallest node of its component.

    Runs until nothing changes: the rounds needed grow with the logarithm of the
    longest chain.  Empty edges give an empty result.
    """
    edges = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    edges = cut(edges.where("a <> b").distinct())

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
