"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step takes the smallest neighbour of each node (a grouped minimum, combined before the shuffle) and links to it. The minima are
stored before they are joined, so both sides of the join come from files and Spark can split the rows of a hub. Edges and labels
stay in tables throughout; the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import run_dir, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node that it reaches. Loops and nulls count for nothing."""
    spark = edges.sparkSession
    at, step = run_dir(spark, "components"), 0
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), f"{at}/0")
    was = _fingerprint(now)
    while was[0]:
        step += 1
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{at}/{step}-large")
        large = both.join(low.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a > b").distinct(), f"{at}/{step}-linked")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), f"{at}/{step}-small")
        near = large.join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(near.unionByName(low.select("a", F.col("m").alias("b"))).filter("a > b").distinct(), f"{at}/{step}")
        # At the fixpoint every node but a root has one edge, to its root.
        new = _fingerprint(now)
        if new == was:
            break
        was = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and the sum of two hashes over them: what two equal tables share, and different ones don't."""
    h = [F.sum(F.xxhash64(F.lit(k), "a", "b").cast("decimal(38,0)")) for k in (1, 2)]
    return tuple(edges.agg(F.count("*"), *h).first())
