"""Calendars, source checks, and comparisons of content."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from trip_rows import minutes, trip

from tallygate.operators import completeness as chk
from tallygate.settings import TRIP_FILE_COLUMNS, Settings
from tallygate.sources import readers

SETTINGS = Settings()


def in_month(month, **changes):
    return replace(SETTINGS, month=month, **changes)


@pytest.mark.parametrize(
    ("month", "real", "labels"),
    [("2026-07", 744, 744), ("2026-03", 743, 743), ("2026-11", 721, 720), ("2026-02", 672, 672),
     ("2026-12", 744, 744)],
)
def test_hours_of_a_month(spark, month, real, labels):
    settings = in_month(month)
    assert chk.hour_spine(spark, settings, wall_clock=False).count() == real
    spine = chk.hour_spine(spark, settings)
    assert spine.count() == labels
    ends = spine.selectExpr("min(hour) AS lo", "max(hour) AS hi").first()
    assert f"{ends['lo']:%Y-%m-%d %H}" == f"{month}-01 00"
    assert f"{ends['hi']:%H}" == "23"


def test_month_bounds():
    december = in_month("2026-12")
    assert (december.month_start, december.month_end) == ("2026-12-01", "2027-01-01")
    assert december.days_in_month == 31
    with pytest.raises(ValueError):
        Settings.from_mapping({"mouth": "2026-07"})
    assert Settings.from_mapping({"sensitivity_minutes": [15, 8]}).late_thresholds == (8, 10, 15)


def hours_with_rows(drop=(), extra=()):
    start = datetime(2026, 7, 1)
    hours = [start + timedelta(hours=i) for i in range(744) if i not in drop]
    return [trip(pickup_ts=h + minutes(9)) for h in hours] + [trip(pickup_ts=e) for e in extra]


def test_full_month_passes(make_trips):
    found = chk.hourly_completeness(make_trips(hours_with_rows()), "pickup_ts", SETTINGS)
    row = chk.require_complete(found.summary)
    assert (row["hours_with_rows"], row["days_with_rows"], row["zero_hours"]) == (744, 31, 0)
    assert row["median_rows_per_hour"] == 1.0 and found.thin_hours.count() == 0


def test_missing_hour_and_outside_rows(make_trips):
    rows = hours_with_rows(drop=[100], extra=[datetime(2026, 8, 1, 0, 4)])
    found = chk.hourly_completeness(make_trips(rows), "pickup_ts", SETTINGS)
    assert [r["hour"] for r in found.zero_hours.collect()] == [datetime(2026, 7, 5, 4)]
    assert found.outside_hours.first()["n_rows"] == 1
    with pytest.raises(chk.CompletenessError):
        chk.require_complete(found.summary)


def test_no_rows_at_all(make_trips):
    found = chk.hourly_completeness(make_trips([]), "pickup_ts", SETTINGS)
    with pytest.raises(chk.CompletenessError):
        chk.require_complete(found.summary)


def test_thin_hour(make_trips):
    rows = hours_with_rows() * 2 + hours_with_rows(drop=[7])
    busy = replace(SETTINGS, low_hour_share=0.7)
    found = chk.hourly_completeness(make_trips(rows), "pickup_ts", busy)
    thin = found.thin_hours.collect()
    assert [(r["hour"], r["n_rows"]) for r in thin] == [(datetime(2026, 7, 1, 7), 2)]


def test_schema_drift(make_trips):
    df = make_trips([trip()])
    missing, extra = chk.schema_drift(df, TRIP_FILE_COLUMNS)
    assert "PULocationID" in missing and "pu_zone_id" in extra


def test_dense_keys(spark):
    assert chk.dense_key_check(spark.range(1, 266), "id", 265).first()["is_dense"]
    assert not chk.dense_key_check(spark.range(1, 265), "id", 265).first()["is_dense"]
    twice = spark.range(1, 265).union(spark.range(1, 2))
    assert not chk.dense_key_check(twice, "id", 265).first()["is_dense"]


def feed(spark, month="2026-07", drop=None, zone="GMT", swap=False, null_at=None):
    settings = in_month(month)
    hours = [r["utc_hour"] for r in chk.real_hours(spark, settings).orderBy("utc_hour").collect()]
    before, after = hours[0] - timedelta(hours=1), hours[-1] + timedelta(hours=1)
    labels = [before, *hours, after]
    if drop is not None:
        labels.pop(drop)
    if swap:
        labels[10], labels[11] = labels[11], labels[10]
    n = len(labels)
    rain = [None if i == null_at else 0.5 for i in range(n)]
    hourly = ([f"{t:%Y-%m-%dT%H:%M}" for t in labels], rain, [1.0] * n, [3] * n)
    doc = spark.createDataFrame(
        [(zone, 40.8, -74.0, hourly)], readers.WEATHER_DOCUMENT_SCHEMA
    )
    return chk.hourly_feed_check(readers.unnest_hourly(doc, "position"), settings, "position")


@pytest.mark.parametrize(("month", "hours"), [("2026-07", 744), ("2026-11", 721)])
def test_weather_feed(spark, month, hours):
    row = chk.require_feed(feed(spark, month, null_at=5))
    assert row["local_hours_present"] == hours and row["returned_hours"] == hours + 2
    assert row["nulls_precipitation"] == 1 and row["nulls_weather_code"] == 0


@pytest.mark.parametrize(
    ("fault", "message"),
    [({"drop": 50}, "missing"), ({"zone": "America/New_York"}, "timezone"),
     ({"swap": True}, "contiguous")],
)
def test_weather_feed_faults(spark, fault, message):
    with pytest.raises(chk.CompletenessError, match=message):
        chk.require_feed(feed(spark, **fault))


def test_short_arrays_pad_with_null(spark):
    doc = spark.createDataFrame(
        [("GMT", 1.0, 2.0, (["a", "b"], [1.0], [3.0, 4.0], None))],
        readers.WEATHER_DOCUMENT_SCHEMA,
    )
    rows = readers.unnest_hourly(doc).collect()
    assert [(r["time_utc"], r["precipitation"]) for r in rows] in (
        [("a", 1.0), ("b", None)],
        [],  # a missing array leaves no hours
    )


def test_sanity_band(spark):
    report = spark.createDataFrame(
        [("2026-07", "FHV - High Volume", "674,877"), ("2026-07", "Yellow", "1,000"),
         ("2026-06", "FHV - High Volume", "1")],
        readers.REPORT_SCHEMA,
    )
    source = spark.range(20_921_249)
    row = chk.sanity_band(report, source, SETTINGS).first()
    assert (row["expected_rows"], row["delta"], row["status"]) == (20_921_187, 62, "within_band")
    few = chk.sanity_band(report, spark.range(10), SETTINGS).first()
    assert few["status"] == "outside_band"
    none = chk.sanity_band(report, source, in_month("2030-01")).first()
    assert none["status"] == "unavailable"


def test_same_content(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "a int, b string, c string")
    b = spark.createDataFrame([(2, "y", None), (1, None, "x")], "a int, b string, c string")
    moved = spark.createDataFrame([(1, "x", None), (2, "y", None)], "a int, b string, c string")
    assert chk.same_content(a, b).first()["identical"]
    assert not chk.same_content(a, moved).first()["identical"]
    assert not chk.same_content(a, a.union(a)).first()["identical"]
    assert chk.row_differences(a, b).count() == 0
    assert {r["side"] for r in chk.row_differences(a, moved).collect()} == {"only_a", "only_b"}
    from tallygate.functions.hashing import fingerprint

    known = fingerprint(a).first()
    chk.verify_recorded(b, known["n_rows"], known["content_sum"])
    with pytest.raises(chk.CompletenessError):
        chk.verify_recorded(moved, known["n_rows"], known["content_sum"])


def test_dst_weather_alignment(spark):
    """Autumn: two real hours share a label and average; spring: the skipped label is absent."""
    from tallygate.operators.star import dim_hour

    rows = [("GMT", 0.0, 0.0, t, mm, temp, code) for t, mm, temp, code in (
        ("2026-11-01T06:00", 2.0, 5.0, 1),  # covers 05-06 UTC = first 01:00; instant second 01:00
        ("2026-11-01T07:00", 4.0, 7.0, 9),  # covers 06-07 UTC = second 01:00; instant 02:00
        ("2026-11-01T05:00", 1.0, 3.0, 0),  # instant reading of the first 01:00
    )]
    weather = spark.createDataFrame(rows, readers.WEATHER_SCHEMA)
    hours = {r["hour_key"]: r for r in dim_hour(weather, in_month("2026-11")).collect()}
    assert len(hours) == 720
    shared = hours[datetime(2026, 11, 1, 1)]
    assert (shared["precipitation_mm"], shared["weather_code"]) == (3.0, 9)
    assert shared["temperature_c"] == 4.0 and shared["dow_name"] == "Sunday"
    assert shared["hour_date"] == date(2026, 11, 1)
    spring = {r["hour_key"] for r in dim_hour(weather, in_month("2026-03")).collect()}
    assert datetime(2026, 3, 8, 2) not in spring and len(spring) == 743
