"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.staging import staged, unstage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie every node's larger (or its smaller) neighbours, and itself, to the smallest node around it.

    The minimum is a map-side aggregate joined back on the node, so a node with very many neighbours is summed where
    its links lie and its join partition can be split.
    """
    if large:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = links.join(least, "u")
    out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else tied.select(
        F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of the links (a, b); links stay distributed."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    seen = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        edges, old = staged(_star(_star(edges, large=True), large=False), "links"), edges
        unstage(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
