"""Lookup joins, and the range join of a weighted choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def two_hop(fact: DataFrame, first: DataFrame, first_key: str, second: DataFrame, second_key: str, value: str, default: str, name: str) -> DataFrame:
    """Left join over two dimensions; a miss at either hop gives the default.  Spark broadcasts what is small."""
    out = fact.join(first, first_key, "left").join(second, second_key, "left")
    return out.withColumn(name, F.coalesce(F.col(value), F.lit(default)))


def members(df: DataFrame, key: str, values: str, ordered: str) -> DataFrame:
    """Multimap: for each key of an array column, the values in ascending order."""
    each = df.select(F.explode(key).alias("member_of"), F.col(ordered).alias("value"))
    return each.groupBy("member_of").agg(F.array_sort(F.collect_list("value")).alias(values))


def cumulative(weights: DataFrame, key: str = "icao", weight: str = "weight", exact: int = 1 << 20) -> DataFrame:
    """(key, low, high): adjoining intervals of cumulative weight, in order of the key.

    Up to ``exact`` keys one task adds them up in order.  More are cut into ranges, by bounds from a sample of the keys,
    which are literals, so that every use sees the same ranges.  Each range is added up by itself, and only one sum for
    each range is in a window without partitions.  An interval's low is the high of the one before, to the last digit,
    so that no draw falls between two or into both.
    """
    rows = weights.select(key, F.col(weight).cast("double").alias("_w"))
    many = rows.count()
    part = F.lit(0)
    if many > exact:
        parts = -(-many // exact)
        sample = sorted(r[0] for r in rows.select(key).where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(20 * parts).collect())
        bounds = F.array(*[F.lit(sample[20 * k]) for k in range(1, parts) if 20 * k < len(sample)])
        part = F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col(key))), F.lit(0))
    rows = rows.withColumn("_part", part)
    inner = Window.partitionBy("_part").orderBy(key)
    run = rows.withColumn("_run", F.sum("_w").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    sums = run.groupBy("_part").agg(F.max("_run").alias("_sum"))
    before = sums.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"))
    run = run.join(F.broadcast(before), "_part").withColumn("high", F.col("_before") + F.col("_run"))  # a row for each range
    return run.withColumn("low", F.coalesce(F.lag("high").over(inner), F.col("_before"))).select(key, "low", "high")


#: Intervals are broadcast up to so many (some 5 MB).
BROADCAST_INTERVALS = 1 << 16


def pick(df: DataFrame, u: Column, intervals: DataFrame, key: str, buckets: int | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Adds the key whose interval holds u * total: an equi-join on buckets of the range, with the bounds as condition.

    An interval is listed under each bucket that it touches, so a row meets the few intervals of its bucket instead of
    all of them; there are as many buckets as intervals, and 1,024 at least, unless ``buckets`` says otherwise.
    ``more`` columns of the intervals come along.
    """
    found = intervals.agg(F.max("high").alias("t"), F.count("*").alias("n")).first()
    total, buckets = found["t"], buckets or max(1024, found["n"])
    if total is None or total <= 0:
        raise ValueError("nothing to choose from: no weight is positive")
    bucket = lambda c: F.least(F.floor(c / F.lit(total) * buckets), F.lit(buckets - 1)).cast("int")
    listed = intervals.where("high > low").select(F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high")))).alias("_bucket"), F.col(key), *more, "low", "high")
    if found["n"] <= BROADCAST_INTERVALS:
        listed = F.broadcast(listed)
    drawn = df.withColumn("_x", u * F.lit(total)).withColumn("_bucket", bucket(F.col("_x")))
    return drawn.join(listed, (drawn["_bucket"] == listed["_bucket"]) & (drawn["_x"] >= listed["low"]) & (drawn["_x"] < listed["high"])).select(*df.columns, key, *more)
