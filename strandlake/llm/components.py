"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node of its component.

    Each round hangs the larger neighbours of a node under its smallest one, then the
    smaller ones. Only minima are taken per node, so that a node with any number of edges is
    one partial aggregate; the rounds grow with the logarithm of the longest path. Each
    round is a written table, so that a lost executor costs one round at most.
    """
    star = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("low"))
        small = down.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))
                      ).alias("e")).select("e.*").filter("u <> v").distinct()
        following = stage(small, "edges")
        # settled when every node hangs under one root that hangs under nothing
        loose = following.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1)
        chained = following.join(following.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1)
        star = following
        if loose.unionByName(chained.select("u", F.lit(0).cast("long").alias("n"))).isEmpty():
            break
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
