"""Connected components of links between documents, as a series of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talweg.llm.common import stage


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("least"))


def connected(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each component, for every node with a link.

    ``links`` has columns a and b. Alternates the large and the small star: each node hands the least
    node it knows to its neighbours. Only minima are gathered by node, never lists of neighbours, and
    every round is a written table, so a lost executor costs tasks of one round.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least_neighbour(both), "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v")).filter("u <> v").distinct()
        )
        small = large.join(_least_neighbour(large), "u")
        edges = stage(
            small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(small.select("u", F.col("least").alias("v")))
            .filter("u <> v").distinct()
        )
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") % 1000003).cast("long"))).first()
        if now == known:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        known = now
