"""Connected components of links, by alternating stars.

Every round hangs the larger neighbours of each node onto the smallest, then does so with the
smaller ones, until nothing changes. Neighbours are never gathered: a node's smallest neighbour is a
partial aggregate, which is joined back to its links, so a node with very many links is no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.shared import drop, stage


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is linked with, of all nodes in links (columns a and b).

    Links lead both ways; null ends and links of a node with itself are left out; repeated ones count once.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stage(edges), None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        new = stage(hung.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        drop(edges)
        edges = new
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    # every node but the roots has one edge now, to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
