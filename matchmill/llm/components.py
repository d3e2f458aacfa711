"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it reaches.

    Links are turned into stars in rounds, their number growing with the logarithm of a component's size: every node
    first gives its larger neighbours, then its smaller ones, the smallest node it knows. Minima are combined before
    the shuffle and joined back, so that no node's neighbours are gathered. Each round is written to the shared folder.
    Links with a null end and links of a node to itself say nothing.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = stage(links.filter("a is not null and b is not null and a <> b").select(high.alias("u"), low.alias("v")).distinct(), "links")
    before = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found[0] == 0 or tuple(found) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = tuple(found)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are tables of their own, so that Spark can split a node with many neighbours over tasks.
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = stage(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
