"""Everything tunable in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from datetime import datetime
from typing import Any

# Licence number -> company name of the public trip data dictionary.
COMPANIES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}

# The 25 columns of the public high-volume trip file.
TRIP_FILE_COLUMNS = (
    "hvfhs_license_num",
    "dispatching_base_num",
    "originating_base_num",
    "request_datetime",
    "on_scene_datetime",
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_miles",
    "trip_time",
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
    "tips",
    "driver_pay",
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
    "cbd_congestion_fee",
)


@dataclass(frozen=True)
class Settings:
    """Thresholds, reference lists and calendar of one monthly run."""

    month: str = "2026-07"
    timezone: str = "America/New_York"

    # lateness, in minutes of wait
    late_minutes: float = 10
    sensitivity_minutes: tuple[float, float] = (8, 15)
    promotion_ratio: float = 2.0

    # weather
    feed_timezone: str = "GMT"
    weather_variables: tuple[str, ...] = ("precipitation", "temperature_2m", "weather_code")
    rain_mm: float = 0.5
    rain_mm_high: float = 2.5

    # gates and completeness
    trust_floor: float = 0.95
    zone_count: int = 265
    low_hour_share: float = 0.05
    aggregate_band: float = 0.01
    license_class: str = "FHV - High Volume"

    # zones
    unknown_zone_ids: tuple[int, ...] = (264, 265)
    unknown_boroughs: tuple[str, ...] = ("Unknown", "N/A")
    airport_service_zones: tuple[str, ...] = ("Airports", "EWR")

    # decision cells
    min_cell_trips: int = 200
    top_n: int = 10
    airport_top_n: int = 5

    # sampling
    sample_modulus: int = 400
    append_per_rule: int = 5
    business_key: tuple[str, ...] = (
        "company_id",
        "base_id",
        "pickup_ts",
        "dropoff_ts",
        "pu_zone_id",
        "do_zone_id",
        "trip_miles",
    )

    companies: dict[str, str] = field(default_factory=lambda: dict(COMPANIES))
    companies_source: str = "data_dictionary_2025-03-18"
    zones_source: str = "taxi_zone_lookup.csv"

    def with_modulus(self, modulus: int) -> Settings:
        return replace(self, sample_modulus=modulus)

    @property
    def late_thresholds(self) -> tuple[float, float, float]:
        """(low, main, high) thresholds in minutes."""
        low, high = sorted(self.sensitivity_minutes)
        return low, self.late_minutes, high

    @property
    def rain_thresholds(self) -> tuple[float, float]:
        return self.rain_mm, self.rain_mm_high

    @property
    def month_start(self) -> str:
        return f"{datetime.strptime(self.month, '%Y-%m'):%Y-%m-%d}"

    @property
    def month_end(self) -> str:
        """First day of the following month (exclusive bound)."""
        start = datetime.strptime(self.month, "%Y-%m")
        years, month = divmod(start.month, 12)
        return f"{start.replace(year=start.year + years, month=month + 1):%Y-%m-%d}"

    @property
    def days_in_month(self) -> int:
        parse = datetime.fromisoformat
        return (parse(self.month_end) - parse(self.month_start)).days

    @classmethod
    def from_mapping(cls, values: dict[str, Any]) -> Settings:
        """Build from a flat mapping, e.g. a parsed YAML or JSON file; unknown keys are an error."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
