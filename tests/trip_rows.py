"""Crafted trips for the tests: a clean one, and changes to it."""

from datetime import datetime, timedelta

#: When the clean trip is requested.
T0 = datetime(2026, 7, 22, 9, 30, 41)

TRIP_SCHEMA = (
    "company_id string, base_id string, originating_base_id string, request_ts timestamp_ntz, "
    "on_scene_ts timestamp_ntz, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, "
    "pu_zone_id int, do_zone_id int, trip_miles double, trip_time bigint, "
    "base_passenger_fare double, tolls double, bcf double, sales_tax double, "
    "congestion_surcharge double, airport_fee double, tips double, driver_pay double, "
    "shared_request_flag string, shared_match_flag string, access_a_ride_flag string, "
    "wav_request_flag string, wav_match_flag string, cbd_congestion_fee double, trip_id bigint"
)
TRIP_COLUMNS = [part.split()[0] for part in TRIP_SCHEMA.split(", ")]


def minutes(n):
    return timedelta(minutes=n)


CLEAN = {
    "company_id": "HV0005",
    "base_id": "B71200",
    "originating_base_id": "B71355",
    "request_ts": T0,
    "on_scene_ts": T0 + minutes(6),
    "pickup_ts": T0 + minutes(8),
    "dropoff_ts": T0 + minutes(32),
    "pu_zone_id": 203,
    "do_zone_id": 47,
    "trip_miles": 7.25,
    "trip_time": 24 * 60,
    "base_passenger_fare": 41.5,
    "tolls": 6.5,
    "bcf": 1.25,
    "sales_tax": 3.75,
    "congestion_surcharge": 2.75,
    "airport_fee": 0.0,
    "tips": 5.0,
    "driver_pay": 30.25,
    "shared_request_flag": "N",
    "shared_match_flag": "N",
    "access_a_ride_flag": "N",
    "wav_request_flag": "N",
    "wav_match_flag": "N",
    "cbd_congestion_fee": 1.5,
}


def trip(**changes):
    """A trip no rule fires on: it waits 8 minutes, boards for 2 and rides 7.25 miles in 24."""
    return CLEAN | changes


def trip_rows(rows):
    return [tuple((r | {"trip_id": i})[c] for c in TRIP_COLUMNS) for i, r in enumerate(rows)]
