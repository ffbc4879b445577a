"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import save


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: ``node, component``.

    ``links`` has two long columns ``a, b``; loops, repeats and either direction
    are allowed, links with a null are none. Links are moved towards the smallest
    neighbour, first on the larger side and then on the smaller side of each node,
    until only stars remain; the number of rounds grows with the logarithm of the
    longest path. Each round is written to the shared folder; only two numbers
    come back. A node with many neighbours is aggregated in part before the
    shuffle, and the join that follows may be split by the engine. The first move
    gives no more rows than it got, so repeats go after the second one only.
    """
    stars = save(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars"
    )
    before = None
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        larger = save(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")), "large")
        lowest = larger.groupBy("a").agg(F.min("b").alias("low"))
        joined = larger.join(lowest, "a")
        stars = save(
            joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(lowest.select("a", F.col("low").alias("b")))
            .distinct(),
            "stars",
        )
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def extended(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` components after further ``links``, of which only those between components move towards each other."""
    of = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    joined = save(components(ends), "joined")
    upper = joined.select(F.col("node").alias("component"), F.col("component").alias("above"))
    old = known.join(upper, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return old.unionByName(joined.join(known.select("node"), "node", "left_anti").select("node", "component"))
