"""Connected components of a table of links, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.sources.settle import settle


def _smallest(links: DataFrame) -> DataFrame:
    """Links (a, b) with ``low``, the smallest neighbour of ``a``.

    The smallest is found by partial sums, so a node with many links is no burden; the
    join back can be split by the adaptive planner.
    """
    return links.join(links.groupBy("a").agg(F.min("b").alias("low")), "a")


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour or itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _smallest(both).where(F.col("b") > F.col("a"))
    return near.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    near = _smallest(links)
    moved = near.select(F.col("b").alias("a"), F.col("low").alias("b"))
    kept = near.select("a", F.col("low").alias("b"))
    return moved.union(kept).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Each linked node with the smallest node of its component: ``node``, ``root``.

    Alternating large and small stars need about the square of the logarithm of the
    longest path in rounds. Every round is settled, which cuts the lineage; links of a node to itself and
    repeated ones do no harm.
    """
    first, second = F.col(a), F.col(b)
    now = settle(
        links.where(first != second)
        .select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
        .distinct()
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = settle(_small_star(_large_star(now)))
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
