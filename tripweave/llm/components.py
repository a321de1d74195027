"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Tie each node's neighbours (the larger, or the smaller and itself) to its least neighbour."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    tied = around.join(least.hint("merge"), "a")
    if large:
        tied = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        tied = tied.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return tied.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes but each component's least, from edges (a, b).

    The component is its least node.  Edges that repeat or tie a node to itself do no harm.  Each
    round is cut off by a checkpoint; rounds grow with the logarithm of the longest path.
    """
    now = cut(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    seen = None
    while True:
        now = cut(_step(_step(now, large=True), large=False))
        found = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
        if found == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = found
