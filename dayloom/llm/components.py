"""Connected components of a graph of links, by alternating star steps on joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the links (a, b).

    Each round points the neighbours of a node at the smallest of them, larger ones first, then
    smaller ones. Rounds grow with the logarithm of the nodes; a round's links are written, so
    plans stay short and a lost executor repeats one round. Minima are taken before the shuffle.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = written(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        small = written(small, "links")
        # Done when all links are stars around the smallest node: no round changes them any more.
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        edges = small
