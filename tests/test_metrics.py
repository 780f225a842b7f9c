"""Metrics, cells and report frames on seven hand-computed trips."""

from dataclasses import replace
from datetime import datetime

import pytest
from trip_rows import TRIP_SCHEMA, minutes, trip, trip_rows

from tallygate.operators import cells as ce
from tallygate.operators import inspect as ins
from tallygate.operators import metrics as m
from tallygate.operators import star as md
from tallygate.operators.stage import stage
from tallygate.operators.validate import apply_rules, kpi_variants, with_hits
from tallygate.rules import DEFAULT_RULES, eligible, flags
from tallygate.settings import Settings
from tallygate.sources.readers import WEATHER_SCHEMA

T12 = datetime(2026, 7, 15, 12, 0, 7)  # local hour 12 is rainy
T14 = datetime(2026, 7, 15, 14, 0, 7)  # dry
SETTINGS = Settings(min_cell_trips=1)


def ride(start, wait, zone, on_scene=None):
    return trip(
        request_ts=start,
        on_scene_ts=on_scene or start + minutes(wait - 1),
        pickup_ts=start + minutes(wait),
        dropoff_ts=start + minutes(wait + 24),
        pu_zone_id=zone,
    )


SEVEN = [
    ride(T12, 2, 203),
    ride(T12, 5, 203),
    ride(T12, 12, 203),
    ride(T12, 20, 203, T12 + minutes(20)),  # arrival not captured
    ride(T12, 15, 203, T12 - minutes(3)),  # pre-arranged
    ride(T14, 3, 50),
    ride(T14, 4, 50),
]
FEED = [
    ("GMT", 40.8, -74.0, f"2026-07-15T{16 + i}:00", mm, 20.0 + i, code)
    for i, (mm, code) in enumerate([(0.0, 0), (3.0, 61), (0.0, 0), (0.0, 0), (0.0, 0)])
]


class Month:
    def __init__(self, spark, make_trips, city, rows=None, feed=None, settings=SETTINGS):
        staged = stage(make_trips(SEVEN if rows is None else rows))
        self.settings = settings
        self.checked = with_hits(staged, DEFAULT_RULES, settings).cache()
        self.sides = apply_rules(staged, DEFAULT_RULES, settings)
        weather = spark.createDataFrame(FEED if feed is None else feed, WEATHER_SCHEMA)
        self.star = md.build_star(self.sides.clean, city, weather, DEFAULT_RULES, settings)
        self.metrics = m.metric_table(
            self.star, self.sides.quarantine, DEFAULT_RULES, settings
        ).cache()

    def lines(self):
        return {
            (r["metric"], r["grain"], r["dimensions"]): (r["value"], r["n"])
            for r in self.metrics.collect()
        }

    def cells(self):
        return ce.rank_cells(
            self.star.fact_trip, self.star.dim_zone, DEFAULT_RULES, self.settings
        )


@pytest.fixture(scope="module")
def month(spark):
    city = spark.range(1, 266).selectExpr(
        "cast(id as int) AS zone_id",
        "CASE WHEN id = 264 THEN 'Unknown' WHEN id = 265 THEN 'N/A' WHEN id <= 100 THEN 'Queens' "
        "ELSE 'Manhattan' END AS borough",
        "concat('Z', id) AS zone",
        "CASE WHEN id IN (132, 138) THEN 'Airports' WHEN id = 1 THEN 'EWR' ELSE 'Boro Zone' END "
        "AS service_zone",
    )
    return Month(spark, lambda r: spark.createDataFrame(trip_rows(r), TRIP_SCHEMA), city)


def near(x):
    return pytest.approx(x, abs=1e-6)


def test_kpi_and_trust_lines(month):
    got = month.lines()
    assert got["M1_late_rate_10", "month", ""] == (near(2 / 6), 6)
    assert got["M1_late_rate_8", "month", ""] == (near(2 / 6), 6)
    assert got["M1_late_rate_15", "month", ""] == (near(1 / 6), 6)
    kept = got["M1_late_rate_10", "month", "variant=pre-arranged kept as measured"]
    assert kept == (near(3 / 7), 7)
    assert got["M2_p90_wait_minutes", "month", ""] == (near(16.0), 6)
    assert got["M3_median_dwell_minutes", "company", "company=HV0005"] == (1.0, 6)
    assert got["M3_dwell_coverage", "company", "company=HV0005"] == (near(6 / 7), 7)
    assert got["M5_trusted_row_share", "month", ""] == (1.0, 7)
    assert got["M5_wait_eligible_share", "month", ""] == (near(6 / 7), 7)
    assert got["M5_dwell_coverage", "month", ""] == (near(6 / 7), 7)
    segment = "company=HV0005|wav_request=false"
    assert got["M5_wait_coverage", "company x wav_request", segment] == (near(6 / 7), 7)
    assert got["M1_late_rate_10", "borough x hour_of_day", "borough=Queens|hour=14"] == (0.0, 2)
    assert m.require_headline(month.metrics, SETTINGS) == near(2 / 6)


def test_rain_is_taken_from_the_label_after_the_hour(month):
    rows = month.star.dim_hour.where("weather_available").collect()
    rain = {r["hour_of_day"]: r["precipitation_mm"] for r in rows}
    heat = {r["hour_of_day"]: r["temperature_c"] for r in rows}
    assert rain[12] == 3.0 and rain[13] == 0.0 and heat[12] == 20.0
    got = month.lines()
    dims = "threshold_mm=0.5"
    assert got["M4_late_rate_rainy", "month", dims] == (0.5, 4)
    assert got["M4_late_rate_dry", "month", dims] == (0.0, 2)
    assert got["M4_rain_minus_dry_late_rate", "month", dims] == (0.5, 6)
    assert got["M4_wet_hours", "month", dims][0] == 1
    # no hour of day has both rainy and dry trips
    assert ("M4_rain_minus_dry_late_rate_hour_adjusted", "month", dims) not in got


def test_missing_weather_is_marked(spark, make_trips, city):
    dry = Month(spark, make_trips, city, feed=[])
    rain = [r for r in dry.metrics.collect() if r["metric"].startswith("M4")]
    assert {r["metric"] for r in rain} == set(m.RAIN_METRICS) and len(rain) == 5
    assert all(r["value"] is None and r["n"] == 0 for r in rain)
    assert all(r["note"].startswith("UNAVAILABLE") for r in rain)


def test_empty_month_has_no_headline(spark, make_trips, city):
    none = Month(spark, make_trips, city, rows=[])
    with pytest.raises(m.MetricsCheckError):
        m.require_headline(none.metrics, SETTINGS)


def test_events_are_never_invented(month):
    events = month.star.fact_trip_event.collect()
    per_trip = {}
    for e in events:
        per_trip.setdefault(e["trip_key"], []).append(e["event_type"])
    assert "on_scene" not in per_trip.pop(3)
    assert all(len(kinds) == 4 for kinds in per_trip.values())
    steps = md.time_in_state(month.star.fact_trip, DEFAULT_RULES).where("trip_key = 3")
    spent = {r["event_type"]: r["minutes_since_previous"] for r in steps.collect()}
    assert spent == {"requested": None, "picked_up": 20.0, "dropped_off": 24.0}


def test_star_checks(month):
    statistics = md.star_statistics(month.star, month.sides.clean, DEFAULT_RULES)
    found = md.check_star(statistics, 744)
    assert found["event_rows"] == 3 * 7 + 6 and found["wet_hours"] == 1
    with pytest.raises(md.StarCheckError):
        md.check_star(statistics, 721)


def test_cells_are_ranked_by_excess(month):
    cells = {r["pu_zone_id"]: r for r in month.cells().collect()}
    assert cells[203]["excess_late_trips"] == near((0.5 - 2 / 6) * 4)
    assert cells[50]["excess_late_trips"] == near((0 - 2 / 6) * 2)
    assert (cells[203]["rank"], cells[50]["rank"]) == (1, 2)
    assert cells[203]["p90_wait_minutes"] == near(17.6)
    assert cells[203]["median_dwell_minutes"] == 1.0


def test_cell_floor(month):
    high = replace(SETTINGS, min_cell_trips=3)
    ranked = ce.rank_cells(month.star.fact_trip, month.star.dim_zone, DEFAULT_RULES, high)
    assert [r["pu_zone_id"] for r in ce.eligible_cells(ranked).collect()] == [203]


def test_airports_are_their_own_list(spark, make_trips, city):
    rows = SEVEN + [ride(T12, 25, 138), ride(T12, 30, 138)]
    with_airport = Month(spark, make_trips, city, rows=rows)
    airports = with_airport.star.dim_zone.where("is_airport").collect()
    assert {r["zone_id"] for r in airports} == {1, 132, 138}
    ranked = with_airport.cells().cache()
    cells = {r["pu_zone_id"]: r for r in ranked.collect()}
    assert (cells[138]["list"], cells[138]["rank"], cells[138]["overall_rank"]) == ("airport", 1, 1)
    assert (cells[203]["list"], cells[203]["rank"]) == ("neighbourhood", 1)
    share = ins.airport_share(ranked, SETTINGS).first()
    assert share["airport_cells"] == 1 and share["first_neighbourhood_overall_rank"] == 2
    top = ins.top_airport_cells(ranked, 5).first()
    assert top["day_hour"] == "Wed 12:00"


def test_report_frames(month):
    lines = ins.evidence(month.metrics, SETTINGS).orderBy("line").collect()
    assert len(lines) == 19
    assert lines[0]["value"] == near(1 / 3) and lines[0]["support_value"] == near(6 / 7)
    grid = {r["borough"]: r for r in ins.heatmap_grid(month.metrics, SETTINGS).collect()}
    assert grid["Manhattan"]["h12"] == near(50.0) and grid["Manhattan"]["h13"] is None
    pairs = {r["scope"]: r for r in ins.rain_pairs(month.metrics, SETTINGS).collect()}
    assert pairs["citywide"]["rainy"] == 0.5 and pairs["citywide"]["dry"] == 0.0
    rain = ins.rain_against_spread(month.metrics, SETTINGS).first()
    assert rain["finding"] == "UNAVAILABLE" and rain["highest_rate"] == 0.5
    assert ins.month_lines(month.metrics).where("grain <> 'month'").count() == 0


def test_kpi_variants(month):
    got = {r["variant"][0]: r for r in kpi_variants(month.checked, DEFAULT_RULES,
                                                     SETTINGS).collect()}
    assert {k: r["n"] for k, r in got.items()} == {"a": 6, "b": 6, "c": 7, "d": 6}
    assert got["c"]["late_rate_main_pct"] == near(300 / 7)


def test_exclusions_follow_the_families(spark):
    """Eligibility names exactly the flags of the rules that exclude the family."""
    for family in ("wait", "dwell", "zone", "pay", "speed", "trip_duration"):
        text = str(eligible(DEFAULT_RULES, family))
        for rule in flags(DEFAULT_RULES):
            assert (rule.flag in text) == (family in rule.excludes), (family, rule.id)


def test_rule_examples(month):
    rule = next(r for r in DEFAULT_RULES if r.id == "R12")
    rows = ins.rule_examples(month.sides.clean, month.sides.quarantine, rule, 5).collect()
    assert [r["trip_id"] for r in rows] == [4]
    total = ins.rule_example_total(month.sides.clean, month.sides.quarantine, rule).first()
    assert total["total_rows"] == 1
    speed = next(r for r in DEFAULT_RULES if r.id == "R10")
    shown = ins.rule_examples(month.sides.clean, month.sides.quarantine, speed, 5).columns
    assert {"trip_miles", "trip_time"} <= set(shown)
