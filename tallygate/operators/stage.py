"""Staging: derived durations beside the raw columns, plus duplicate marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID
from tallygate.functions.derive import minutes_between, seconds_between
from tallygate.operators.duplicates import mark_exact_duplicates

# Columns staging adds; everything else in a staged table came from the source.
DERIVED = (
    "wait_minutes",
    "dwell_minutes",
    "trip_minutes",
    "timestamp_trip_minutes",
    "duration_gap_seconds",
    "speed_mph",
    "dup_rank",
    "dup_count",
)


def with_durations(trips: DataFrame) -> DataFrame:
    """Waits, dwells and speeds.  ``trip_time`` (seconds) is trusted over the dropoff timestamp."""
    trip_seconds = F.col("trip_time")
    ride = seconds_between("pickup_ts", "dropoff_ts")
    return trips.withColumns(
        {
            "wait_minutes": minutes_between("request_ts", "pickup_ts"),
            "dwell_minutes": minutes_between("on_scene_ts", "pickup_ts"),
            "trip_minutes": trip_seconds / F.lit(60.0),
            "timestamp_trip_minutes": ride / F.lit(60.0),
            "duration_gap_seconds": trip_seconds - ride,
            "speed_mph": F.when(
                trip_seconds > 0, F.col("trip_miles") / (trip_seconds / F.lit(3600.0))
            ),
        }
    )


def stage(trips: DataFrame, raw_columns: Sequence[str] | None = None) -> DataFrame:
    """The rows a run works on; two rows are copies when all their raw columns are equal."""
    raw = list(raw_columns or [c for c in trips.columns if c != ROW_ID])
    return mark_exact_duplicates(with_durations(trips), raw, ROW_ID)
