"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.workspace import stage


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``label``) for every node of the links (``a``, ``b``) but the labels: label is the least node.

    Large star: every larger neighbour of a node is linked to the least of its neighbours and itself; small
    star: the same for the smaller neighbours. The links shrink to stars around the least nodes, in a number
    of rounds that grows with the logarithm of the longest path. Every round is a written table; nothing is
    collected but a count and a checksum.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("x"), "u", "m")
        small = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "small-star")
