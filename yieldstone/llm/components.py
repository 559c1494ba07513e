"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``links`` (columns ``a`` and ``b``).

    Large-star and small-star rounds (Kiveris et al. 2014): each node hooks its greater, then its smaller neighbours to the
    least one it sees, until every link points straight at its component's least node. Minima are taken before the
    shuffle, so a node with very many links is no single task's work, and each round is stored, which keeps plans short.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    edges, turn = scratch.keep(edges, "links0"), 0
    while not _are_stars(edges):
        turn += 1
        both = edges.union(edges.select("lo", "hi")).toDF("node", "near")
        least = both.groupBy("node").agg(F.min("near").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").where("near > node").select(F.col("near").alias("hi"), F.col("least").alias("lo"))
        large = large.where("hi <> lo").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(down, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        small = small.union(down.select("hi", "least")).where("hi <> lo").distinct()
        edges = scratch.keep(small, f"links{turn}")
    ends = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return ends.union(edges.select("lo", "lo").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two lower ends, or one while it is the lower end of another link itself."""
    up = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    roles = up.union(edges.select("lo", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR up > 0 AND down > 0").isEmpty()
