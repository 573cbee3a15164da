"""Choosing rows: the first or best of a key, the first accepted up to a target, anti-joins, shards."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import written


def first_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The row of each key that comes first; partial minimums, so a hot key costs a row per task."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    won = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return won.select(*keys, "_row.*").select(*df.columns)


def longest_per_key(df: DataFrame, key: str, size: str, order: str) -> DataFrame:
    """The row of each key with the greatest size, the earlier on a tie, and first_ord, where the key first stood."""
    rest = [c for c in df.columns if c != key]
    rank = F.struct(F.col(size), -F.col(order))
    won = df.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("_row"), F.min(order).alias("first_ord"))
    return won.select(key, "_row.*", "first_ord").select(*df.columns, "first_ord")


RANGE_ROWS = 1 << 20
RANGES = 1 << 16


def ranges(df: DataFrame, order: str, rows: int = RANGE_ROWS) -> Column:
    """The number of the range of a whole-number order that a row falls into: 64 ranges, or as many as give each about
    ``rows`` rows, up to ``RANGES``; bounds are approximate quantiles.

    Bounds are literals, so every use of the column sees the same ranges, whatever the partitioning.  A row looks at
    every so-manieth bound, then at those between two: twice the square root of all.
    """
    parts = min(max(64, -(-df.count() // rows)), RANGES)
    steps = [k / parts for k in range(1, parts)]
    bounds = sorted(set(df.agg(F.percentile_approx(order, steps, max(10_000, 20 * parts)).alias("b")).first()["b"] or []))
    if not bounds:
        return F.lit(0)
    every = math.isqrt(len(bounds)) + 1
    array = lambda some: F.from_json(F.lit(json.dumps([int(b) for b in some])), "array<bigint>")
    upto = lambda some: F.size(F.filter(some, lambda b: b <= F.col(order)))
    block = upto(array(bounds[::every]))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * every + upto(F.slice(array(bounds), (block - 1) * every + 1, F.lit(every))))


def _before(ranged: DataFrame, count: Column) -> DataFrame:
    """(_part, _before): how much all earlier ranges count.  One row per range."""
    totals = ranged.groupBy("_part").agg(F.sum(count).alias("_n"))
    return totals.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))


def up_to_target(candidates: DataFrame, speaker: list[str], order: str, ok: Column, exists: Column, room: int) -> DataFrame:
    """All rows with ``kept``, ``processed`` and ``skipped``, as a loop in that order would decide them.

    The loop takes the first acceptable row of each speaker, passes over those that exist, and stops once ``room`` are
    kept.  Positions come from counts per range of the order and a running sum over those ranges, so no task holds the
    whole order: only one row per range is in the unpartitioned window.
    """
    decided = candidates.withColumn("_ok", ok).withColumn("_exists", exists)
    first = written(decided.where("_ok").groupBy(*speaker).agg(F.min(order).alias("_first")))
    marked = decided.join(first, speaker, "left").withColumn("_isdec", F.coalesce(F.col(order) == F.col("_first"), F.lit(False)))
    marked = marked.withColumn("_cand", F.col("_isdec") & ~F.col("_exists"))
    ranged = marked.withColumn("_part", ranges(candidates, order))
    before = _before(ranged, F.col("_cand").cast("long"))
    inner = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(before), "_part").withColumn("_seen", F.col("_before") + F.coalesce(F.sum(F.col("_cand").cast("long")).over(inner), F.lit(0)))
    placed = placed.withColumn("processed", F.col("_seen") < F.lit(max(0, room)))
    placed = placed.withColumn("kept", F.col("_cand") & F.col("processed")).withColumn("skipped", F.col("processed") & ~F.col("_isdec"))
    return placed.select(*candidates.columns, "kept", "processed", "skipped")


def without(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key isn't among those of ``existing``."""
    return df.join(existing.select(key), key, "left_anti")


def among(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is among those of ``existing``."""
    return df.join(existing.select(key), key, "left_semi")


def concatenated(frames: list[DataFrame], order: str = "ord") -> DataFrame:
    """Sources one after the other: ``order`` becomes the place of the source in its upper bits, the order within below."""
    out = None
    for k, df in enumerate(frames):
        own = df.withColumn(order, F.lit(k << 48) + F.col(order).cast("long"))
        out = own if out is None else out.unionByName(own)
    return out


def sharded(df: DataFrame, order: str, shard_size: int, first_shard: int = 0) -> DataFrame:
    """Adds shard_id: rows in order, ``shard_size`` to a shard; the running count is kept per range, not in one task."""
    ranged = df.withColumn("_part", ranges(df, order))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return ranged.join(F.broadcast(_before(ranged, F.lit(1))), "_part").withColumn("shard_id", F.floor(place / shard_size).cast("long") + first_shard).select(*df.columns, "shard_id")
