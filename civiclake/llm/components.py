"""Connected components of links between integer nodes, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.plans.scratch import written


def _with_least(links: DataFrame, include_self: bool) -> DataFrame:
    """Each link (u, v) with the least neighbour of u; partially aggregated, so a hub is no large group."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    if include_self:
        least = least.select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    known = _with_least(links, False)
    moved = known.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(known.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("decimal(38,0)")).alias("h"),
        ).first()
    )


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node it is connected with.

    Each round is one large-star and one small-star step over the links that are left, written to
    the shared folder, so a lost executor never sets a round back. Rounds grow with the logarithm
    of the number of nodes; no component or neighbourhood is ever held in one place. Repeated links
    and links of a node with itself are allowed; an empty table gives an empty table.
    """
    current = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    state = _state(current)
    while state[0]:
        current = written(_small_star(written(_large_star(current).distinct(), "links")).distinct(), "links")
        if (following := _state(current)) == state:
            break
        state = following
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
