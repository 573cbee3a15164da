"""Dimension scans: airports, aircraft, custom weights, and the regions of countries.  Each is a parameter: a file of one's own
replaces the bundled table."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import RESOURCES, RegionConfig


def _bundled(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A small table of the package, read by the driver: executors needn't have the file."""
    with (RESOURCES / name).open(newline="", encoding="utf-8") as lines:
        rows = list(csv.reader(line for line in lines if not line.startswith("#")))
        return spark.createDataFrame(rows[1:], schema)


def countries(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(country, region): the bundled table, or a CSV with these columns."""
    return spark.read.schema(schemas.COUNTRY).csv(path, header=True, comment="#") if path else _bundled(spark, "countries.csv", schemas.COUNTRY)


def with_region(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with the region of their country, by a left join; ``other`` without one or with one that isn't known."""
    return rows.join(known, "country", "left").withColumn("region", F.coalesce("region", F.lit("other"))).select(*rows.columns, "region")


def airports(spark: SparkSession, path: str | None = None, regions: DataFrame | None = None) -> DataFrame:
    """(icao, country, region) of codes of four capitals; the bundled list, or a CSV with icao and country."""
    found = spark.read.schema(schemas.AIRPORT).csv(path, header=True) if path else _bundled(spark, "airports.csv", schemas.AIRPORT)
    return coded(found, countries(spark) if regions is None else regions)


def coded(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows with an icao of four capitals, and the region of their country."""
    return with_region(rows.where(F.col("icao").rlike("^[A-Z]{4}$")), regions)


def aircraft(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The aircraft table with its classes as an array."""
    found = spark.read.schema(schemas.AIRCRAFT_ROW).csv(path, header=True) if path else _bundled(spark, "aircraft.csv", schemas.AIRCRAFT_ROW)
    return found.withColumn("operator_classes", F.split("operator_classes", r"\|"))


def by_class(craft: DataFrame) -> DataFrame:
    """(operator_class, members): the aircraft of each class, in the order of their codes."""
    each = craft.select(F.explode("operator_classes").alias("operator_class"), F.struct("icao_type", "wake").alias("member"))
    return each.groupBy("operator_class").agg(F.array_sort(F.collect_list("member")).alias("members"))


def custom_weights(spark: SparkSession, path: str) -> DataFrame:
    """(icao, weight) of a CSV, or of a folder of them in the order of their names; the last row of a code counts."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = spark.read.schema(schemas.WEIGHT).csv(path, header=True).select("icao", "weight", place.alias("place"))
    return rows.groupBy("icao").agg(F.max_by("weight", "place").alias("weight"))


def uniform_weights(ports: DataFrame) -> DataFrame:
    return ports.select("icao", F.lit(1.0).alias("weight"))


def tier_weights(ports: DataFrame, config: RegionConfig, more: Sequence[str] = ()) -> DataFrame:
    """Weights by tier: airports without a tier, and tiers without a weight, get the default.  ``more`` columns come along."""
    default = config.tier_weights["default"]
    tiers = ports.sparkSession.createDataFrame([(k, config.tier_weights.get(str(v), default)) for k, v in config.airport_tiers.items()], "icao string, tier_weight double")
    return ports.join(F.broadcast(tiers), "icao", "left").select("icao", F.coalesce("tier_weight", F.lit(float(default))).alias("weight"), *more)
