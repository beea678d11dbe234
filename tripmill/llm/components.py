"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import settle


def _to_smallest(links: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours, by a pre-aggregated minimum."""
    return links.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.join(_to_smallest(both), "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a != b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _to_smallest(down)
    return (
        down.join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(least.select("a", F.col("least").alias("b")))
        .where("a != b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Large-star and small-star rounds, alternately: each node's neighbours move to the
    smallest one until only stars are left, in a number of rounds that grows with the
    logarithm of the graph. Every round is written to the shared folder. A hub's links
    meet one row of minima, a join that adaptive execution splits. Self-links are
    ignored; no link gives an empty table.
    """
    links = settle(links.select("a", "b").where("a != b").distinct(), "links")
    before = None
    while True:
        links = settle(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
