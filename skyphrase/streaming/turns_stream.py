"""Structured Streaming: raw model outputs arrive as files, leave as transcripts and failures.  An extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import turns

RAW = "id string, focal string, raw string, at timestamp"


def raw_outputs(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def parsed(raw: DataFrame) -> DataFrame:
    """Adds turns and error; works on a stream as on a batch."""
    out = raw.withColumn("turns", turns.parse_turns(F.col("raw")))
    return out.withColumn("error", turns.turn_error(F.col("turns"), F.col("focal")))


def outcome_rate(raw: DataFrame, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Accepted and failed outputs per window of event time; late rows count until the watermark passes."""
    rows = parsed(raw.withWatermark("at", late))
    return rows.groupBy(F.window("at", window)).agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def start(raw: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's accepted rows and failures; a batch that is run again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        rows = parsed(batch).persist()
        rows.where("error is null").select("id", "turns", "at").write.mode("overwrite").parquet(f"{out}/transcripts/batch={number}")
        rows.where("error is not null").select("id", "focal", "error", "at").write.mode("overwrite").json(f"{out}/failures/batch={number}")
        rows.unpersist()

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
