"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _sum(edges: DataFrame) -> tuple:
    """Number and summed hashes of edges: the same for the same edges, without a shuffle of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b): root is the smallest id of its component.

    Alternates two contractions: every neighbour larger than a node is linked to the node's smallest neighbour,
    then every smaller one.  Edges only get closer to the smallest id, so a few rounds end with stars.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _sum(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = stage(small.where("a <> b").distinct(), "small-star")
        if (sums := _sum(after)) == seen:
            break
        now, seen = after, sums
    roots = after.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(after.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
