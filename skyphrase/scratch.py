"""Intermediate tables in the folder that driver and executors share, and who deletes them."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where a local session names none, one is made; on a cluster
    that is an error, as executors don't see each other's folders."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="skyphrase-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark writes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_owner: ContextVar[list[Scratch] | None] = ContextVar("owner", default=None)


class Scratch:
    """A folder of written intermediates: they cut lineage, survive lost executors, and can be dropped when used up.

    What a result still reads must stay until the result is stored; whoever stores it opens ``owned()`` around the call,
    which deletes the folders made within it, in the same thread, and no others.
    """

    def __init__(self, spark: SparkSession, kind: str = "skyphrase"):
        self.spark, self.top = spark, f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
        self.count = 0
        self.held: list[DataFrame] = []
        owner = _owner.get()
        if owner is not None:
            owner.append(self)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` as a table that is written now."""
        self.count += 1
        path = f"{self.top}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.held.append(out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes the files of frames that nothing reads any more."""
        self.held = [df for df in self.held if not any(df is x for x in frames)]
        for df in frames:
            remove(self.spark, df._scratch_path)

    def keep_only(self, *frames: DataFrame) -> None:
        self.drop(*[df for df in self.held if not any(df is x for x in frames)])

    def release(self) -> None:
        self.held = []
        remove(self.spark, self.top)


@contextmanager
def owned() -> Iterator[list[Scratch]]:
    """Deletes, at its end, the intermediates of all that is called within, in this thread."""
    mine: list[Scratch] = []
    token = _owner.set(mine)
    try:
        yield mine
    finally:
        _owner.reset(token)
        for scratch in mine:
            scratch.release()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table that is written now.  An aggregate that is joined back to its rows becomes a plain side of that
    join: Spark may then split a hot key on the other side, and nothing is computed twice."""
    return Scratch(df.sparkSession, "table").write(df)
