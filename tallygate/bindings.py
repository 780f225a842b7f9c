"""Logical roles of a trip, and how a physical table fills them.

The operators use the role names below.  A binding is a rename: it costs nothing at run time and
can be undone for exports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Public trip-file column -> role.  Columns not listed keep their name.
TRIP_FILE_ROLES = {
    "hvfhs_license_num": "company_id",
    "dispatching_base_num": "base_id",
    "originating_base_num": "originating_base_id",
    "request_datetime": "request_ts",
    "on_scene_datetime": "on_scene_ts",
    "pickup_datetime": "pickup_ts",
    "dropoff_datetime": "dropoff_ts",
    "PULocationID": "pu_zone_id",
    "DOLocationID": "do_zone_id",
}

# Public zone lookup column -> role.
ZONE_FILE_ROLES = {
    "LocationID": "zone_id",
    "Borough": "borough",
    "Zone": "zone",
}

# Source column each workflow event takes its timestamp from.
EVENT_SOURCES = {
    "request_ts": "request_datetime",
    "on_scene_ts": "on_scene_datetime",
    "pickup_ts": "pickup_datetime",
    "dropoff_ts": "dropoff_datetime",
}

# Lineage: 0-based position of the row in its source.
ROW_ID = "trip_id"


def bind(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(roles)


def unbind(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({role: source for source, role in roles.items()})
