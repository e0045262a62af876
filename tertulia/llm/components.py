"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written


def _lowest(edges: DataFrame) -> DataFrame:
    """Of each u the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """id and component (the smallest id reachable) of every id that links (a, b) name.

    Every round aggregates neighbours to their minimum before anything moves, so a node
    with any number of links costs each task one row; the number of rounds grows with the
    logarithm of the longest chain. Links of an id with itself or with null are ignored.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _lowest(large)
        stars = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(stars.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.min("v")).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = now
