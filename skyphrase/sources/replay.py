"""Failure files read back: scenarios to run again, and lines that can't be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.folder import Folder


def parsed(line: Column, schema: str) -> Column:
    """The line as a struct; null fields and the line itself in _corrupt_record if it isn't JSON."""
    return F.from_json(line, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def failures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows of schemas.FAILURE, unreadable lines); blank lines count as neither."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "")
    read = lines.select("value", parsed(F.col("value"), schemas.FAILURE).alias("row"))
    bad = F.col("row._corrupt_record").isNotNull() | F.col("row.scenario").isNull()
    return read.where(~bad).select("row.*").drop("_corrupt_record"), read.where(bad).select("value")


def inspect(spark: SparkSession, folder: str) -> dict[str, int]:
    """Shard files, rows and failure lines of an output folder."""
    own = Folder(spark, folder)
    shards = own.names("shard-")
    return {
        "shards": len(shards),
        "rows": spark.read.parquet(f"{own.path}/shard-*.parquet").count() if shards else 0,
        "failures": spark.read.option("recursiveFileLookup", True).text(f"{own.path}/failures.jsonl").where(F.trim("value") != "").count() if own.exists("failures.jsonl") else 0,
    }
