"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b); the root is the smallest
    node of its component. Each round is a written table; the rounds grow with the
    logarithm of the longest path. Loops and repeated edges do no harm."""
    current = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stored(current, "stars")
    mark = None
    while True:
        sides = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("low"))
        large = sides.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        large = stored(large.where("a != b").distinct(), "stars")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(joined.select("a", F.col("low").alias("b")))
        current = stored(small.where("a != b").distinct(), "stars")
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = now


def merged(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, root) of earlier ones and further links (a, b), stored. Only the roots that the links
    join are searched; without earlier components this is :func:`components`."""
    if groups is None:
        return stored(components(links), "components")
    ends = links
    for end in ("a", "b"):
        root = groups.select(F.col("node").alias(end), F.col("root").alias("to"))
        ends = ends.join(root, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    joined = stored(components(ends.select("a", "b")), "components")
    moved = joined.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    old = groups.join(moved, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    new = joined.join(groups.select("node"), "node", "left_anti")
    return stored(old.unionByName(new), "components")
