"""Connected components of a graph of links, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the least node of its component, for all nodes that have a link. Node names are 64-bit integers.

    Each round hangs every node's larger neighbours, then its smaller ones, on its least neighbour; paths shorten to stars
    in a number of rounds that grows as the logarithm of the nodes. Minima combine before they move, so a node with very many
    links is no burden. Each round is a written table.
    """
    edges = written(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo <> hi").distinct(), "links")
    before = None
    while True:
        # Larger neighbours of each node to its least one.
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo <> hi").distinct()
        # Smaller neighbours, and the node itself, to the least of them.
        large = written(large, "links-large")
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = large.join(small, "hi").select(F.col("m").alias("x"), F.col("lo").alias("y")).unionByName(small.select(F.col("m").alias("x"), F.col("hi").alias("y")))
        edges = written(hung.filter("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), "links-small")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
