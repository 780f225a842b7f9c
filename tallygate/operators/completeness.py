"""Is the source whole?  Calendar-aware row checks, each returned as rows or as one result row."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.functions.derive import to_wall_clock, wall_hour
from tallygate.functions.hashing import fingerprint
from tallygate.settings import Settings
from tallygate.sources.readers import report_lookup


class CompletenessError(RuntimeError):
    """The source lacks rows or columns the run needs."""


class HourlyCompleteness(NamedTuple):
    summary: DataFrame
    zero_hours: DataFrame
    thin_hours: DataFrame
    outside_hours: DataFrame


def _utc(local_midnight: str, zone: str) -> Column:
    local = F.to_timestamp_ntz(F.lit(local_midnight))
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def real_hours(spark: SparkSession, settings: Settings) -> DataFrame:
    """``(utc_hour, hour)``: every real hour of the local month, daylight saving included."""
    last = _utc(settings.month_end, settings.timezone) - F.expr("INTERVAL 1 HOUR")
    hours = F.sequence(
        _utc(settings.month_start, settings.timezone), last, F.expr("INTERVAL 1 HOUR")
    )
    return spark.range(1).select(F.explode(hours).alias("utc_hour")).select(
        "utc_hour", to_wall_clock("utc_hour", settings.timezone).alias("hour")
    )


def hour_spine(spark: SparkSession, settings: Settings, wall_clock: bool = True) -> DataFrame:
    """Local hours of the month; ``wall_clock`` keeps each label once (autumn repeats one)."""
    hours = real_hours(spark, settings).select("hour")
    return hours.distinct() if wall_clock else hours


def hourly_counts(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(wall_hour(ts).alias("hour")).agg(F.count("*").alias("n_rows"))


def hourly_completeness(df: DataFrame, ts: str, settings: Settings) -> HourlyCompleteness:
    """Rows per wall-clock hour against the month's calendar.

    Everything after the first aggregation handles one row per hour.
    """
    expected = hour_spine(df.sparkSession, settings)
    counts = hourly_counts(df, ts)
    inside = counts.join(expected, "hour", "left_semi")
    outside = counts.join(expected, "hour", "left_anti")
    zero = expected.join(counts, "hour", "left_anti")
    median = inside.agg(F.coalesce(F.median("n_rows"), F.lit(0.0)))
    floor = F.lit(settings.low_hour_share) * median.scalar()
    thin = inside.where(F.col("n_rows") < floor)
    labelled = expected.withColumn("expected", F.lit(True)).join(counts, "hour", "full")
    has_rows = F.col("n_rows").isNotNull()
    due = F.coalesce(F.col("expected"), F.lit(False))
    day = F.to_date("hour")
    summary = labelled.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min(F.when(has_rows, F.col("hour"))).alias("min_hour"),
        F.max(F.when(has_rows, F.col("hour"))).alias("max_hour"),
        F.count_if(due).alias("expected_hours"),
        F.count_if(due & has_rows).alias("hours_with_rows"),
        F.count_if(due & ~has_rows).alias("zero_hours"),
        F.coalesce(F.median(F.when(due, F.col("n_rows"))), F.lit(0.0)).alias(
            "median_rows_per_hour"
        ),
        F.count_distinct(F.when(due, day)).alias("expected_days"),
        F.count_distinct(F.when(due & has_rows, day)).alias("days_with_rows"),
        F.coalesce(F.sum(F.when(~due, F.col("n_rows"))), F.lit(0)).alias("rows_outside_month"),
    )
    return HourlyCompleteness(summary, zero, thin, outside)


def require_complete(summary: DataFrame) -> dict:
    """Fail on an empty source, missing hours or missing days (collects one row)."""
    result = summary.first().asDict()
    if not result["n_rows"]:
        raise CompletenessError("trips: no rows")
    if result["zero_hours"] or result["days_with_rows"] != result["expected_days"]:
        raise CompletenessError(f"trips: {result['zero_hours']} hour(s) have no rows")
    return result


def schema_drift(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) columns; missing is fatal to a run, extra is only worth a warning."""
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    return missing, extra


def dense_key_check(df: DataFrame, key: str, n: int, first: int = 1) -> DataFrame:
    """One row: do the ids run from ``first`` over ``n`` values, each exactly once?"""
    found = df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(key).alias("n_ids"),
        F.min(key).cast("bigint").alias("min_id"),
        F.max(key).cast("bigint").alias("max_id"),
    )
    whole = (
        (F.col("n_rows") == n)
        & (F.col("n_ids") == n)
        & (F.col("min_id") == first)
        & (F.col("max_id") == first + n - 1)
    )
    return found.withColumn("is_dense", F.coalesce(whole, F.lit(False)))


def feed_time(label: str | Column) -> Column:
    """A feed label such as 2026-07-01T16:00 as a UTC NTZ timestamp."""
    return F.to_timestamp_ntz(label, F.lit("yyyy-MM-dd'T'HH:mm"))


def hourly_feed_check(feed: DataFrame, settings: Settings, position: str) -> DataFrame:
    """One row: time zone, presence of every local hour, contiguity and NULLs of an hourly feed.

    ``position`` is the row's index in the feed.  Bounded by the hours of a month.
    """
    expected = real_hours(feed.sparkSession, settings)
    labelled = feed.withColumn("utc_hour", feed_time("time_utc"))
    last_copy = labelled.groupBy("utc_hour").agg(
        F.max_by(F.struct(position, *settings.weather_variables), position).alias("v")
    )
    found = expected.join(last_copy, "utc_hour", "left")
    # contiguous: positions advance by one with time, so position - ordinal never changes
    ordinal = F.row_number().over(Window.orderBy("utc_hour"))
    steps = found.withColumn("offset", F.col(f"v.{position}") - ordinal)
    hours = steps.agg(
        F.count("*").alias("expected_local_hours"),
        F.count("v").alias("local_hours_present"),
        (F.min("offset") == F.max("offset")).alias("one_run"),
        *[
            F.count_if(F.col("v").isNotNull() & F.col(f"v.{c}").isNull()).alias(f"nulls_{c}")
            for c in settings.weather_variables
        ],
    )
    header = feed.agg(
        F.count("*").alias("returned_hours"),
        F.count_if(~F.col("timezone").eqNullSafe(F.lit(settings.feed_timezone))).alias(
            "rows_in_other_timezone"
        ),
    )
    # two one-row results, stacked and merged
    both = hours.unionByName(header, allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    complete = F.col("local_hours_present") == F.col("expected_local_hours")
    return merged.withColumn(
        "contiguous", complete & F.coalesce(F.col("one_run"), F.lit(False))
    ).drop("one_run")


def require_feed(check: DataFrame) -> dict:
    """Fail on a wrong time zone, missing hours or a feed that is out of order."""
    r = check.first().asDict()
    if r["rows_in_other_timezone"]:
        raise CompletenessError("weather: unexpected response timezone")
    if r["local_hours_present"] != r["expected_local_hours"]:
        lost = r["expected_local_hours"] - r["local_hours_present"]
        raise CompletenessError(f"weather: {lost} local hours missing")
    if not r["contiguous"]:
        raise CompletenessError("weather: hourly timestamps are not contiguous")
    return r


def sanity_band(report: DataFrame, source: DataFrame, settings: Settings) -> DataFrame:
    """One row comparing the source's row count with the aggregate report; never fails a run."""
    per_day = report_lookup(report, settings).agg(F.max("trips_per_day").alias("trips_per_day"))
    actual = source.agg(F.count("*").alias("actual_rows"))
    both = per_day.unionByName(actual, allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    days = F.lit(settings.days_in_month).cast("bigint")
    row = merged.select(
        "trips_per_day",
        days.alias("days"),
        (F.col("trips_per_day") * days).alias("expected_rows"),
        "actual_rows",
    )
    delta = F.col("actual_rows") - F.col("expected_rows")
    row = row.withColumns(
        {
            "delta": delta,
            "delta_share": F.try_divide(
                F.abs(delta).cast("double"), F.col("expected_rows").cast("double")
            ),
        }
    )
    return row.withColumn(
        "status",
        F.when(F.col("trips_per_day").isNull(), "unavailable")
        .when(F.col("delta_share") <= settings.aggregate_band, "within_band")
        .otherwise("outside_band"),
    )


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: do two tables hold the same rows, in whatever order?"""
    left = fingerprint(a).select(
        F.col("n_rows").alias("rows_a"), F.col("content_sum").alias("sum_a")
    )
    right = fingerprint(b).select(
        F.col("n_rows").alias("rows_b"), F.col("content_sum").alias("sum_b")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return merged.select(
        "rows_a",
        "rows_b",
        ((F.col("rows_a") == F.col("rows_b")) & (F.col("sum_a") == F.col("sum_b"))).alias(
            "identical"
        ),
    )


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table missing from the other (with multiplicity), labelled by side."""
    columns = a.columns
    only_a = a.exceptAll(b.select(*columns)).withColumn("side", F.lit("only_a"))
    only_b = b.select(*columns).exceptAll(a).withColumn("side", F.lit("only_b"))
    return only_a.unionByName(only_b)


def verify_recorded(df: DataFrame, n_rows: int, content_sum: str) -> None:
    """Compare a source with a recorded fingerprint; raise when the content changed."""
    found = fingerprint(df).first()
    if (found["n_rows"], found["content_sum"]) != (n_rows, content_sum):
        raise CompletenessError("source content does not match its recorded fingerprint")


def same_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: raw rows against source rows (a count reads no column data)."""
    left = a.agg(F.count("*").alias("rows_a"))
    both = left.unionByName(b.agg(F.count("*").alias("rows_b")), allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return merged.withColumn("equal", F.col("rows_a") == F.col("rows_b"))
