"""Readers for trips (Parquet), zones and reports (CSV) and hourly weather (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID, TRIP_FILE_ROLES, ZONE_FILE_ROLES, bind
from tallygate.settings import Settings
from tallygate.sources.writers import materialise

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
REPORT_SCHEMA = "`Month/Year` string, `License Class` string, `Trips Per Day` string"
WEATHER_SCHEMA = (
    "timezone string, grid_latitude double, grid_longitude double, time_utc string, "
    "precipitation double, temperature_2m double, weather_code bigint"
)
WEATHER_DOCUMENT_SCHEMA = (
    "timezone string, latitude double, longitude double, hourly struct<time: array<string>, "
    "precipitation: array<double>, temperature_2m: array<double>, weather_code: array<bigint>>"
)


def read_with_row_number(
    spark: SparkSession, path: str, name: str = "file_row_number", file: str | None = None
) -> DataFrame:
    """A Parquet source plus the 0-based position of every row, and its file as column ``file``.

    The reader's own row index, offset by the row counts of the files before it in path order,
    which come from file footers, not from column data.  Runs a job that writes the offsets, one row
    per file: the join is then planned from their real size and the source is not shuffled.
    """
    df = spark.read.parquet(path)
    per_file = df.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").count()
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file, so this single-partition window is as long as the file list
    offsets = materialise(
        per_file.select(
            "_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
        ),
        "row-offsets",
    )
    indexed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    placed = indexed.join(offsets, "_file").withColumn(name, F.col("_offset") + F.col("_index"))
    if file is not None:
        placed = placed.withColumn(file, F.col("_file"))
    return placed.drop("_file", "_offset", "_index")


def load_trips(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """Trips under their role names with ``trip_id`` = position in the source."""
    return bind(read_with_row_number(spark, path, ROW_ID, file), TRIP_FILE_ROLES)


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).schema(ZONE_SCHEMA).csv(path)
    return bind(raw, ZONE_FILE_ROLES)


def unnest_hourly(document: DataFrame, position: str | None = None) -> DataFrame:
    """One row per hour of a document holding parallel hourly arrays; short arrays pad with NULL.

    ``position`` names a column for the 0-based index in the arrays (the feed's own order).
    """
    zipped = F.arrays_zip(
        F.col("hourly.time").alias("time_utc"),
        F.col("hourly.precipitation").alias("precipitation"),
        F.col("hourly.temperature_2m").alias("temperature_2m"),
        F.col("hourly.weather_code").alias("weather_code"),
    )
    rows = document.select(
        "timezone",
        F.col("latitude").alias("grid_latitude"),
        F.col("longitude").alias("grid_longitude"),
        F.posexplode(zipped).alias("_pos", "_hour"),
    )
    return rows.select(
        "timezone",
        "grid_latitude",
        "grid_longitude",
        *[F.col(f"_hour.{c}").alias(c) for c in
          ("time_utc", "precipitation", "temperature_2m", "weather_code")],
        *([F.col("_pos").cast("bigint").alias(position)] if position else []),
    )


def load_weather(spark: SparkSession, path: str | None) -> DataFrame:
    """Hourly weather; without a path a typed, empty table, so the gap stays visible."""
    if path is None:
        return spark.createDataFrame([], WEATHER_SCHEMA)
    document = spark.read.schema(WEATHER_DOCUMENT_SCHEMA).option("multiLine", True).json(path)
    return unnest_hourly(document)


def load_report(spark: SparkSession, path: str) -> DataFrame:
    """The monthly aggregate report, restricted to the columns the sanity band needs."""
    raw = spark.read.option("header", True).csv(path)
    wanted = [c.split("`")[1] for c in REPORT_SCHEMA.split(", ")]
    clean = {c: c.lstrip("﻿") for c in raw.columns}
    return raw.withColumnsRenamed(clean).select(*[F.col(f"`{c}`") for c in wanted])


def report_lookup(report: DataFrame, settings: Settings) -> DataFrame:
    """``trips_per_day`` of the month and licence class; thousands commas removed."""
    return report.where(
        (F.col("`Month/Year`") == settings.month)
        & (F.col("`License Class`") == settings.license_class)
    ).select(
        F.regexp_replace(F.col("`Trips Per Day`"), ",", "").cast("bigint").alias("trips_per_day")
    )

