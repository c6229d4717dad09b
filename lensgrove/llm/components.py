"""Connected components by alternating star contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace



def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, space: Workspace, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node of its component.

    Nodes are compared by value. The number of rounds grows with the logarithm of the longest chain; each round's
    edges are written to the shared folder, and the loop ends when two rounds agree. Null ends are ignored, and no
    edges give no rows. RuntimeError if ``most`` rounds don't suffice.
    """
    now = space.put(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    sign = None
    for _ in range(most):
        new = space.put(_small_star(_large_star(now)))
        got = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        space.drop(now)
        now = new
        if sign == tuple(got):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        sign = tuple(got)
    raise RuntimeError(f"components didn't settle in {most} rounds")
