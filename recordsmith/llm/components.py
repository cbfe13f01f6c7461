"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import drop_stash, stash


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these neighbours."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"),
                                                                        F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a and b, any integers).

    The component is its smallest node. Null ends, loops and repeated edges are ignored;
    no edges give no rows. Each round is written to the shared folder, so a lost executor
    costs at most that round; the minima are aggregated before they are shuffled, and a hub
    is an ordinary skewed join key.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct())
    e, seen = stash(e, "edges"), None
    while True:
        now = _digest(e)
        if now == seen or not now[0]:
            break
        after = stash(_small_star(_large_star(e)), "edges")
        drop_stash(e)
        e, seen = after, now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
