"""Connected components by alternating star steps, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` for every node of a link: the least node reachable, itself included.

    Every step turns links into stars around smaller nodes: first each node's
    larger neighbours are linked to the least of its neighbourhood, then its
    smaller neighbours. The number of links never grows, steps are few (about the
    logarithm of the longest path), and each is a grouped minimum, which is
    combined before the shuffle, and a join, in which a hub with most of the
    links is split. Each result is written to the shared folder, which cuts the
    lineage. Null nodes have no links; a link from a node to itself, or a second
    copy of a link, changes nothing; no links give no rows.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    edges = written(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        # to the least of each node's neighbourhood: first for larger neighbours, seen from both ends
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # then for smaller neighbours and the node itself
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").filter("u <> v").distinct()
        edges = written(small, "links")
        # done when all are stars: no node has two links upward, or one above it and one below
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty():
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    nodes = stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    alone = pairs.filter("u = v").select(F.col("u").alias("node")).distinct().join(nodes.select("node"), "node", "left_anti")
    return nodes.unionByName(alone.select("node", F.col("node").alias("root")))
