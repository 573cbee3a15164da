"""Shared plumbing: tables, bounded broadcasts, numpy/Arrow glue; intermediates are those of the library (``scratch.py``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..scratch import Scratch, owned, remove, shared_dir  # noqa: F401  the operators' own names for them
from . import textops


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table of ids or other narrow rows is broadcast up to so many rows (some 16 to 64 MB), whatever Spark's own threshold.
BROADCAST_ROWS = 1 << 20


def sized(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, a written table of narrow rows: broadcast if it has at most ``most`` rows, or else joined by sorting, so that
    no estimate from the size of compressed files leads to a larger broadcast."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if most is None else most) else df.hint("merge")


def shielded(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but the named ones in one struct, and a function that puts them back in order.

    Whatever an operator calls its own columns, they can't clash with those of the table.
    """
    from pyspark.sql import functions as F

    rest = [c for c in df.columns if c not in names]
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    packed = df.select(*[quoted[c] for c in names], F.struct(*[quoted[c] for c in rest] or [F.lit(0).alias("none")]).alias("_extra"))

    def restore(out: DataFrame, *more: str) -> DataFrame:
        return out.select(*[quoted[c] if c in names else F.col("_extra").getField(c).alias(c) for c in df.columns], *more)

    return packed, restore


def by_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text", limit: int = textops.SLICE_BYTES):
    """A mapInArrow function that hands ``work`` slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, column, limit):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out

    return run


def col(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def binaries(values, border) -> pa.Array:
    """Row d's bytes are those of values[border[d]:border[d+1]] (a contiguous numpy array)."""
    import numpy as np

    off = (np.asarray(border, dtype=np.int64) * values.itemsize)
    if off[-1] < 2**31 - 1:
        return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.large_binary())
