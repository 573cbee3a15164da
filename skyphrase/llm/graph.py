"""Connected components of an edge list, as alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b), any order, loops and repeats allowed -> (node, root): the smallest node reachable.

    Each round keeps at most as many edges as the one before and takes O(log n) rounds in practice, whatever the
    diameter.  Minimums are partially aggregated and written before they are joined back to the edges, so that both
    sides of the join are plain shuffles and Spark may split the rows of a hot centre, which are on the edges' side.
    Nothing is collected but one row of counts per round.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = scratch.write(both)
    seen = None
    for _ in range(max_rounds):
        sym = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.write(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = sym.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = scratch.write(large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        low = scratch.write(down.groupBy("u").agg(F.min("v").alias("m")))
        small = down.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        after = scratch.write(small.where("u <> v").distinct())
        mark = after.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)).alias("s")).first()
        scratch.drop(now, least, down, low)
        now = after
        if seen == mark:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = scratch.write(now.select(F.col("u").alias("node"), F.col("v").alias("root")))
    scratch.drop(now)
    return out
