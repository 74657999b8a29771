"""Connected components of links between numbers, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node connected with it.

    Rounds of two steps: each node hangs its larger neighbours, then its smaller ones, on the smallest number it sees.
    Both keep connections, and stars are all that is left after a number of rounds that grows as a logarithm.
    A node's neighbours are never gathered: their minimum is an aggregate, joined back. Each round is written to
    the shared folder.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = kept(links.select(high.alias("a"), low.alias("b")).filter("a <> b").distinct(), "links")

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    now, previous = state(edges), None
    while now != previous:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Larger neighbours move to the least of the node's neighbourhood, the node itself included.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = kept(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now, previous = state(edges), now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
