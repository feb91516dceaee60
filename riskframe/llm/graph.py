"""Connected components of an edge table by alternating large-star / small-star rounds.

Every round is grouped minima and joins over the edges; nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import dropped, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to its smallest neighbour (large: only the larger ones; small: only the
    not larger ones, and the node itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    moved = (both.where("b > a") if large else near).join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select(F.col("a").alias("u"), F.col("m").alias("v")))
    return moved.where("u != v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    ``edges`` has long columns a < b.  Rounds end when the edge set no longer changes, which then is one star per
    component; their number grows with the logarithm of the longest path.
    """
    current, before = written(edges.select("a", "b").distinct(), "edges"), None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == before:
            break
        before = tuple(seen)
        after = written(_star(_star(current, large=True), large=False), "edges")
        dropped(current)
        current = after
    stars = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
