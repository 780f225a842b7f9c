"""Star schema: zone, company, base and hour dimensions, the trip fact and its event log."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.bindings import EVENT_SOURCES, ROW_ID
from tallygate.functions.derive import (
    hour_number,
    iso_weekday,
    minutes_between,
    to_wall_clock,
    wall_hour,
)
from tallygate.operators.completeness import feed_time, hour_spine
from tallygate.rules import Rule, eligible, flags
from tallygate.settings import Settings

FACT_KEYS = ("trip_key", "company_id", "pu_zone_id", "request_ts", "pickup_ts", "request_hour_key")


class Star(NamedTuple):
    dim_zone: DataFrame
    dim_company: DataFrame
    dim_base: DataFrame
    dim_hour: DataFrame
    fact_trip: DataFrame
    fact_trip_event: DataFrame


class StarCheckError(RuntimeError):
    """A structural check of the star schema failed."""


def dim_zone(zones: DataFrame, settings: Settings) -> DataFrame:
    return zones.select(
        "zone_id",
        "borough",
        "zone",
        "service_zone",
        F.col("zone_id").isin(list(settings.unknown_zone_ids)).alias("is_unknown"),
        F.col("service_zone").isin(list(settings.airport_service_zones)).alias("is_airport"),
        F.lit(settings.zones_source).alias("source"),
    )


def dim_company(like: DataFrame, settings: Settings) -> DataFrame:
    rows = [(k, v, settings.companies_source) for k, v in sorted(settings.companies.items())]
    return like.sparkSession.createDataFrame(
        rows, "company_id string, company_name string, source string"
    )


def dim_base(clean: DataFrame) -> DataFrame:
    """Base ids seen in either role; one scan, combined before the shuffle."""
    ids = F.array("base_id", "originating_base_id")
    seen = clean.select(F.posexplode(ids).alias("role", "base_id"))
    # a missing originating base is no base; a missing dispatching base stays visible
    known = seen.where((F.col("role") == 0) | F.col("base_id").isNotNull())
    return known.select("base_id").distinct().select(
        "base_id",
        F.lit(None).cast("string").alias("base_name"),
        F.lit("trip file (names unavailable)").alias("source"),
    )


def dim_hour(weather: DataFrame, settings: Settings) -> DataFrame:
    """Local hours of the month with their weather.

    Precipitation and weather code at a label describe the hour before it, so local hour H takes
    them from the label one hour later; temperature is an instant reading at the label.  The
    autumn label that two real hours share averages both.
    """
    zone = settings.timezone
    labelled = weather.withColumn("label", feed_time("time_utc"))
    hour_before = F.col("label") - F.expr("INTERVAL 1 HOUR")
    over_hour = labelled.groupBy(to_wall_clock(hour_before, zone).alias("hour_key")).agg(
        F.avg("precipitation").alias("precipitation_mm"),
        F.max("weather_code").alias("weather_code"),
    )
    at_hour = labelled.groupBy(to_wall_clock("label", zone).alias("hour_key")).agg(
        F.avg("temperature_2m").alias("temperature_c")
    )
    hours = hour_spine(weather.sparkSession, settings).withColumnRenamed("hour", "hour_key")
    rain = F.col("precipitation_mm")
    return (
        hours.join(over_hour, "hour_key", "left")
        .join(at_hour, "hour_key", "left")
        .select(
            "hour_key",
            F.to_date("hour_key").alias("hour_date"),
            iso_weekday("hour_key").alias("dow"),
            F.date_format("hour_key", "EEEE").alias("dow_name"),
            hour_number("hour_key").alias("hour_of_day"),
            "precipitation_mm",
            "temperature_c",
            "weather_code",
            (rain >= settings.rain_mm).alias("is_rainy"),
            (rain >= settings.rain_mm_high).alias("is_rainy_moderate"),
            rain.isNotNull().alias("weather_available"),
        )
    )


def late_column(threshold: float) -> str:
    return f"is_late_{threshold:g}"


def fact_trip(clean: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """One row per clean trip; every FLAG travels along, so exclusions stay row filters."""
    yes = {
        "shared_request": "shared_request_flag",
        "wav_request": "wav_request_flag",
        "wav_match": "wav_match_flag",
        "access_a_ride": "access_a_ride_flag",
    }
    return clean.select(
        F.col(ROW_ID).alias("trip_key"),
        "company_id",
        "base_id",
        "originating_base_id",
        "pu_zone_id",
        "do_zone_id",
        "request_ts",
        "on_scene_ts",
        "pickup_ts",
        "dropoff_ts",
        wall_hour("request_ts").alias("request_hour_key"),
        iso_weekday("request_ts").alias("request_dow"),
        hour_number("request_ts").alias("request_hour"),
        "wait_minutes",
        minutes_between("request_ts", "on_scene_ts").alias("request_to_arrival_minutes"),
        "dwell_minutes",
        "trip_minutes",
        "timestamp_trip_minutes",
        "trip_miles",
        "driver_pay",
        "base_passenger_fare",
        *[
            (F.col("wait_minutes") > t).alias(late_column(t))
            for t in settings.late_thresholds
        ],
        *[(F.col(flag) == "Y").alias(name) for name, flag in yes.items()],
        *[r.flag for r in flags(rules)],
        "flag_r05_survivor",
    )


def _workflow(captured: Column) -> Column:
    """The trip's events in order; an arrival that was not captured is absent, not invented."""

    def event(order: int, kind: str, ts: str) -> Column:
        return F.struct(
            F.lit(order).cast("bigint").alias("event_order"),
            F.lit(kind).alias("event_type"),
            F.col(ts).alias("event_ts"),
            F.lit(EVENT_SOURCES[ts]).alias("event_source"),
        )

    return F.array_compact(
        F.array(
            event(1, "requested", "request_ts"),
            F.when(captured, event(2, "on_scene", "on_scene_ts")),
            event(3, "picked_up", "pickup_ts"),
            event(4, "dropped_off", "dropoff_ts"),
        )
    )


def fact_trip_event(fact: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """3 or 4 rows per trip from one scan of the fact."""
    return fact.select("trip_key", F.inline(_workflow(eligible(rules, "dwell"))))


def time_in_state(fact: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Minutes since the trip's previous event (NULL for the first).

    A trip's events sit in one row of the fact, so the previous event is an array lookup and no
    trip has to be shuffled or sorted.
    """
    events = fact.select("trip_key", _workflow(eligible(rules, "dwell")).alias("events"))
    steps = events.select("trip_key", "events", F.posexplode("events").alias("i", "e"))
    previous = F.when(F.col("i") > 0, F.col("events")[F.col("i") - 1]["event_ts"])
    return steps.select(
        "trip_key",
        F.col("e.event_order").alias("event_order"),
        F.col("e.event_type").alias("event_type"),
        F.col("e.event_ts").alias("event_ts"),
        minutes_between(previous, F.col("e.event_ts")).alias("minutes_since_previous"),
    )


def build_star(
    clean: DataFrame,
    zones: DataFrame,
    weather: DataFrame,
    rules: Sequence[Rule],
    settings: Settings,
) -> Star:
    fact = fact_trip(clean, rules, settings)
    return Star(
        dim_zone(zones, settings),
        dim_company(clean, settings),
        dim_base(clean),
        dim_hour(weather, settings),
        fact,
        fact_trip_event(fact, rules),
    )


def star_statistics(star: Star, clean: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with every count the structural checks need.

    The fact is read once for its own counts; the unknown-company count joins distinct companies.
    """
    null_key = F.lit(False)
    for key in FACT_KEYS:
        null_key = null_key | F.col(key).isNull()
    facts = star.fact_trip.agg(
        F.count("*").alias("fact_rows"),
        F.count_if(null_key).alias("fact_rows_with_null_key"),
        F.count_if(eligible(rules, "dwell")).alias("captured_arrivals"),
    )
    per_company = star.fact_trip.groupBy("company_id").agg(F.count("*").alias("n"))
    strangers = per_company.join(star.dim_company, "company_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_with_unknown_company")
    )
    hours = star.dim_hour.agg(
        F.count("*").alias("hours"),
        F.count_if("weather_available").alias("hours_with_weather"),
        F.count_if("is_rainy").alias("wet_hours"),
    )
    parts = [
        facts,
        strangers,
        hours,
        clean.agg(F.count("*").alias("clean_rows")),
        star.fact_trip_event.agg(F.count("*").alias("event_rows")),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def check_star(statistics: DataFrame, expected_hours: int) -> dict:
    """Raise on the first structural failure (collects one row)."""
    s = statistics.first().asDict()
    if s["fact_rows"] != s["clean_rows"]:
        raise StarCheckError(f"fact has {s['fact_rows']} rows, clean has {s['clean_rows']}")
    if s["fact_rows_with_null_key"]:
        raise StarCheckError(f"{s['fact_rows_with_null_key']} fact rows have a NULL key")
    if s["event_rows"] != 3 * s["fact_rows"] + s["captured_arrivals"]:
        raise StarCheckError("event rows do not match 3 x trips + captured arrivals")
    if s["hours"] not in (expected_hours, expected_hours - 1):  # autumn shares one label
        raise StarCheckError(f"dim_hour has {s['hours']} rows, expected {expected_hours}")
    if s["rows_with_unknown_company"]:
        raise StarCheckError(f"{s['rows_with_unknown_company']} trips have an unknown company")
    return s
