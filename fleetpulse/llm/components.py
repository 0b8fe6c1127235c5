"""Connected components of an edge table: alternating large-star and small-star.

Every step is a grouped minimum (combined before the shuffle) and a join whose
hot nodes AQE splits; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(pairs: DataFrame, keep) -> DataFrame:
    """pairs (u, v): every kept v, and u, linked to the least node around u."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (least node of its component) of every node that has an edge.

    ``edges`` has long columns u, v without nulls.  Rounds grow with the
    logarithm of a component's size; loops are ignored.
    """
    now = scratch.write(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges-0")
    mark, turn = None, 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        turn += 1
        large = scratch.write(_star(both, "v > u"), f"edges-{turn}a")
        now = scratch.write(_star(large, "true"), f"edges-{turn}b")
        h = F.xxhash64("u", "v")
        new = now.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(F.xxhash64(F.lit(2), "u", "v"))).first()
        if tuple(new) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(new)
