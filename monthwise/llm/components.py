"""Connected components by alternating large-star and small-star steps; every step is aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import written


def _settled(edges: DataFrame) -> bool:
    """Whether every node points at one node at most, and none that is pointed at points on."""
    ends = edges.selectExpr("stack(2, u, 1, 0, v, 0, 1) AS (node, points, pointed)")
    return (ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("pointed").alias("pointed"))
            .where("points > 1 OR points = pointed").isEmpty())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another.

    Links may repeat and point either way; a link of a node to itself or to null adds nothing.  No links give an
    empty result.  Steps need about the logarithm of the longest path; each is written to the shared folder, so a
    lost executor costs one step.  A node with very many links is combined before the shuffle, and its join is
    one that Spark can split.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
                    "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        edges = written(joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
