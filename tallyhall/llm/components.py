"""Connected components of a large graph as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b);
    ``component`` is the smallest node reachable.

    Alternates the large-star and the small-star step: a node's larger, then
    its smaller neighbours are linked to the smallest of them, until every
    edge leads to a smallest node. The rounds grow with the logarithm of a
    component's size. A node with very many neighbours is a skewed key of
    one side of an inner join, which adaptive execution splits; its minimum
    is pre-aggregated. Every round is checkpointed.
    """
    pairs = (edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
             .where("u < v").distinct().checkpoint())
    state = None
    while True:
        pairs = _small_star(_large_star(pairs)).checkpoint()
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = pairs.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.union(pairs.select("u", "u")).distinct()


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select("v", "u")).toDF("n", "m")
    least = both.groupBy("n").agg(F.min("m").alias("m0")).select("n", F.least("n", "m0").alias("m0"))
    return (both.where("m > n").join(least, "n")
            .select(F.col("m0").alias("u"), F.col("m").alias("v")).where("u < v").distinct())


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("v").agg(F.min("u").alias("m0"))
    moved = pairs.join(least, "v")
    return (moved.select(F.col("m0").alias("a"), F.col("u").alias("b"))
            .union(least.select(F.col("m0"), F.col("v")))
            .where("a < b").distinct().toDF("u", "v"))
