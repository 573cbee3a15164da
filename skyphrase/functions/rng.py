"""Counter-based randomness as Columns: a draw depends on (seed, row id, slot) only.

Results don't depend on partitioning, any row can be drawn by itself, and skipping ahead is a range that starts later.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(seed: int, row_id: Column) -> Column:
    """What the texts of a row's draws begin with."""
    return F.concat(F.lit(f"{seed}:"), row_id.cast("string"), F.lit(":"))


def fraction(text: Column) -> Column:
    """A double in [0, 1): the first 52 bits of the text's sha1.  They fit a double whole, and a long is read faster than one."""
    return F.conv(F.substring(F.sha1(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") * F.lit(2.0**-52)


def uniform(seed: int, row_id: Column, slot: str | Column) -> Column:
    """A double in [0, 1): the first 52 bits of sha1("seed:id:slot")."""
    return fraction(F.concat(stem(seed, row_id), F.lit(slot) if isinstance(slot, str) else slot))


def fast_uniform(seed: int, row_id: Column, slot: str | Column) -> Column:
    """The same contract from xxhash64, about three times as fast; other engines can't reproduce it."""
    slot = F.lit(slot) if isinstance(slot, str) else slot
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_id, slot), 11).cast("double") / F.lit(float(2**53))


def integer(u: Column, low: int | Column, high: int | Column) -> Column:
    """Uniform whole number between low and high, both included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return low.cast("long") + F.floor(u * (high - low + 1)).cast("long")


def real(u: Column, low: float | Column, high: float | Column) -> Column:
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    return low + u * (high - low)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once.  Within a lambda Spark evaluates an expression as often as it is mentioned."""
    return F.transform(F.array(value), use)[0]


def weighted(u: Column, weights: Mapping[str, float], of: Callable[[str], Column] = F.lit) -> Column:
    """A label, or what ``of`` makes of it, with probability in proportion to its weight; a chain of comparisons, within codegen."""
    total, run, out = float(sum(weights.values())), 0.0, None
    for label, weight in weights.items():
        run += weight
        test = u * F.lit(total) < F.lit(run)
        out = F.when(test, of(label)) if out is None else out.when(test, of(label))
    return out.otherwise(of(list(weights)[-1]))


def choice(u: Column, items: Column) -> Column:
    """An element of an array, each alike; null of an empty one."""
    return F.get(items, F.floor(u * F.size(items)).cast("int"))


def squawk(u: Column) -> Column:
    """Four octal digits, none of the three reserved codes: an index among the others, moved past those below it."""
    code = F.floor(u * 4093).cast("int")
    for reserved in (0o7500, 0o7600, 0o7700):
        code = code + F.when(code >= reserved, 1).otherwise(0)
    return F.lpad(F.conv(code.cast("string"), 10, 8), 4, "0")
