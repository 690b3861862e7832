"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that ``edges`` (columns a, b) name; component is the smallest node.

    Each step is written to the shared folder, so a lost executor costs one step. The number of steps grows with
    the logarithm of the longest chain. Edges to itself or with a null end say nothing; no edges, no rows.
    """
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    while True:
        before, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        now = materialise(_small_star(_large_star(now)).where("a <> b").distinct(), "edges")
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
