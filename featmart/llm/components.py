"""Connected components of a graph given as edges, by alternating stars.

Every step keeps for each node an edge to the smallest node it sees, until nothing changes: the graph is then a set of stars
round the smallest node of each component. Steps are aggregates and joins on node ids, written out one by one; neither the
edges nor the components ever meet in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workdir import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """`edges` (a, b) with a > b. Large star: larger neighbours go to the smallest one; small star: smaller neighbours do."""
    if large:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return seen.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_steps: int = 100) -> DataFrame:
    """(node, root) for every node that has an edge, the root being the smallest node of its component.

    `edges` has the columns a and b of one ordered type; direction and repeats don't matter. Raises an error when `max_steps` don't do.
    """
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_steps):
        following = cut(_star(cut(_star(state, True), "large-star"), False), "small-star")
        before, after = (df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for df in (state, following))
        state = following
        if before == after:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_steps} steps")
