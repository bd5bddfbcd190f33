"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected(links: DataFrame, rounds: int = 64) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with a link.

    ``links`` has columns ``u`` and ``v``.  Each round points nodes at the smallest
    neighbour they know; minima are combined before the shuffle, and no neighbour list is
    gathered, so a node with very many links is no hot spot.  Each round is written, which
    cuts the lineage.  A round that changes nothing ends the loop.
    """
    edges = materialize(links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = materialize(
            small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "links")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("links did not settle")
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
