"""Connected components by alternating star operations on edge tables; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.llm.runtime import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is moved to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are moved to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)`` but the smallest of each component, which names it."""
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        edges = stored(_small_star(_large_star(edges).where("u <> v").distinct()).where("u <> v").distinct(), "edges")
