"""Connected components of a link table by alternating stars, with every step a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, stored


def _lowest(links: DataFrame, by: str, other: str) -> DataFrame:
    """For each node its lowest neighbour, stored: the join with it is then one of two plain shuffles, which AQE splits at a hub."""
    return stored(links.groupBy(F.col(by).alias("node")).agg(F.min(other).alias("low")), "lowest")


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the lowest of the node and its neighbours."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
    low = _lowest(both, "u", "v")
    moved = both.where("v > u").join(low, F.col("u") == F.col("node"))
    return moved.select(F.col("v").alias("hi"), F.least("u", "low").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its lower neighbours move to the lowest of them."""
    low = _lowest(links, "hi", "lo")
    joined = links.join(low, F.col("hi") == F.col("node"))
    moved = joined.where("lo <> low").select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
    return moved.union(low.select(F.col("node").alias("hi"), F.col("low").alias("lo"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of long nodes → (node, root), the root being the smallest node reachable; roots themselves are left out.

    Rounds grow with the logarithm of the longest path. Each round is written to the shared folder, so that no lineage
    builds up; the round before is deleted. Only a count and a checksum reach the driver.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    now = stored(links.distinct(), "links")
    state = _state(now)
    while True:
        star = stored(_large_star(now), "links")
        after = stored(_small_star(star), "links")
        discard(now)
        discard(star)
        now, before, state = after, state, _state(after)
        if state == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
