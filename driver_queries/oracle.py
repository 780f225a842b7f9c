"""Reference SQL for the registered queries, written for DuckDB over the driver's views.

Each statement is assembled from named CTE blocks.  Doubles are rounded to six decimals, like the
registered queries' results.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


def r6(expression: str, alias: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {alias}"


def big(expression: str, alias: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {alias}"


def n_if(condition: str, alias: str) -> str:
    return big(f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)", alias)


def pct(condition: str, alias: str) -> str:
    return r6(f"100 * avg(CAST(({condition}) AS INT))", alias)


# ------------------------------------------------------------------ trips from events

EVENT_TRIPS = """
ev0 AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
         CAST(round(value * 100) AS INT) AS cents
  FROM events
), ev1 AS (
  SELECT *, CASE WHEN user_id % 37 = 5 THEN cents // 8 * 20
                 WHEN user_id % 11 = 3 THEN -(cents // 8) ELSE cents // 8 END AS wait_s,
         k * 15 + user_id % 3 * 60 AS ride_s
  FROM ev0
), ev2 AS (SELECT *, ts + to_seconds(wait_s) AS picked FROM ev1),
trips AS (
  SELECT event_id AS trip_id, event_type AS company_id, 'B' || (user_id % 40) AS base_id,
    CASE WHEN k % 5 <> 0 THEN 'B' || (k % 45) END AS originating_base_id,
    ts AS request_ts,
    CASE WHEN k % 13 = 0 THEN NULL
         WHEN k % 9 = 0 THEN picked
         WHEN user_id % 11 = 3 AND k % 10 = 1 THEN ts + to_seconds(30)
         WHEN user_id % 11 = 3 THEN ts - to_seconds(60)
         WHEN k % 17 = 0 THEN ts - to_seconds(90)
         ELSE ts + to_seconds(wait_s // 2) END AS on_scene_ts,
    picked AS pickup_ts,
    picked + to_seconds(CASE WHEN k % 25 = 3 THEN 0 WHEN k % 20 = 7 THEN ride_s + 200
                             ELSE ride_s END) AS dropoff_ts,
    CAST(user_id % 25 AS BIGINT) AS pu_zone_id, CAST(k % 25 AS BIGINT) AS do_zone_id,
    CASE WHEN k % 30 = 11 THEN 0.0::DOUBLE ELSE cents::DOUBLE / 2000 END AS trip_miles,
    CAST(ride_s AS BIGINT) AS trip_time,
    value - 1::DOUBLE AS fare, value * 0.75::DOUBLE - 0.05::DOUBLE AS pay,
    k % 6 = 0 AS shared, k % 50 = 0 AS assisted, user_id % 10 = 0 AS wav,
    user_id % 20 = 0 AS wav_matched
  FROM ev2
)"""

_TRIP_COLUMNS = """company_id, base_id, originating_base_id, request_ts, on_scene_ts, pickup_ts,
  dropoff_ts, pu_zone_id, do_zone_id, trip_miles, trip_time, fare, pay, shared, assisted, wav,
  wav_matched"""
# rows equal in every column but their id
COPIES = f"""trips AS (
  SELECT *, row_number() OVER (PARTITION BY {_TRIP_COLUMNS} ORDER BY trip_id) AS dup_rank,
    count(*) OVER (PARTITION BY {_TRIP_COLUMNS}) AS dup_count FROM plain_trips
)"""
PLAIN_TRIPS = EVENT_TRIPS.replace("\ntrips AS (", "\nplain_trips AS (")
EVENT_TRIPS = f"{PLAIN_TRIPS}, {COPIES}"
_MOVED = ", ".join(
    f"CASE WHEN trip_id % 200 = 11 THEN {c} + INTERVAL 31 DAY ELSE {c} END AS {c}"
    for c in ("request_ts", "on_scene_ts", "pickup_ts", "dropoff_ts"))
FAULTY_TRIPS = PLAIN_TRIPS.replace("\nplain_trips AS (", "\nsound_trips AS (") + f""", changed AS (
  SELECT * REPLACE (CASE WHEN trip_id % 300 = 13 THEN 'ghost' ELSE company_id END AS company_id,
    CASE WHEN trip_id % 400 <> 17 THEN pu_zone_id END AS pu_zone_id, {_MOVED}) FROM sound_trips
), plain_trips AS (
  SELECT * FROM changed
  UNION ALL SELECT * REPLACE (trip_id + 1000000000000 AS trip_id) FROM changed WHERE trip_id % 50 = 7
  UNION ALL SELECT * REPLACE (trip_id + 2000000000000 AS trip_id) FROM changed
    WHERE trip_id % 150 = 7
), {COPIES}"""

DURATIONS = """
timed AS (
  SELECT *,
    date_diff('microsecond', request_ts, pickup_ts) / 1e6 / 60 AS wait,
    date_diff('microsecond', on_scene_ts, pickup_ts) / 1e6 / 60 AS dwell,
    date_diff('microsecond', request_ts, on_scene_ts) / 1e6 / 60 AS approach,
    date_diff('microsecond', pickup_ts, dropoff_ts) / 1e6 AS ride,
    CASE WHEN trip_time > 0 THEN trip_miles / (trip_time / 3600.0) END AS mph
  FROM trips
)"""

RULE_TESTS = {
    "r05": "dup_rank > 1",
    "r04": "pickup_ts < TIMESTAMP '2024-01-01' OR pickup_ts >= TIMESTAMP '2024-02-01'",
    "r01": "wait < 0 AND NOT (on_scene_ts < request_ts)",
    "r03": "wait > 180",
    "r06": "mph > 65",
    "r02": "dropoff_ts <= pickup_ts",
    "r07": "abs(trip_time - ride) > 120",
    "r08": "pu_zone_id IN (23, 24)",
    "r09": "on_scene_ts IS NULL",
    "r10": "trip_miles = 0 AND trip_time > 60",
    "r11": "pay < 0 OR fare < 0",
    "r12": "on_scene_ts < request_ts",
    "r13": "on_scene_ts >= pickup_ts",
    "r14": "second(request_ts) = 0",
}
REJECT_IDS = ["r05", "r04", "r01", "r03", "r06"]
FLAG_IDS = [r for r in RULE_TESTS if r not in REJECT_IDS]
RULE_NAMES = {
    "r05": "exact duplicate row",
    "r04": "pickup outside target month",
    "r01": "pickup before request, not pre-arranged",
    "r03": "implausibly long wait",
    "r06": "implausible implied speed",
    "r02": "dropoff not after pickup (timestamp defect)",
    "r07": "trip_time disagrees with timestamps",
    "r08": "unknown pickup zone",
    "r09": "on_scene missing",
    "r10": "zero miles with non-trivial duration",
    "r11": "negative pay or fare",
    "r12": "pre-arranged pickup (on_scene before request)",
    "r13": "dwell not captured (on_scene at or after pickup)",
    "r14": "request on a whole minute (possible reservation)",
}
EXCLUDED = {
    "r02": "timestamp_duration",
    "r07": "trip_duration",
    "r08": "zone",
    "r09": "dwell",
    "r10": "speed",
    "r11": "pay",
    "r12": "wait",
    "r13": "dwell",
}

JUDGED = (
    "judged0 AS (SELECT *, "
    + ", ".join(f"coalesce({test}, FALSE) AS {r}" for r, test in RULE_TESTS.items())
    + " FROM timed), judged AS (SELECT *, "
    + " OR ".join(REJECT_IDS)
    + " AS rejected, NOT r12 AS wait_ok, NOT (r09 OR r13) AS dwell_ok, "
    + "CASE "
    + " ".join(f"WHEN {r} THEN '{r.upper()}'" for r in REJECT_IDS)
    + " END AS filed, concat_ws(',', "
    + ", ".join(f"CASE WHEN {r} THEN '{r.upper()}' END" for r in REJECT_IDS)
    + ") AS all_filed, "
    + " + ".join(f"{r}::INT" for r in REJECT_IDS)
    + " AS n_filed FROM judged0), kept AS (SELECT * FROM judged WHERE NOT rejected)"
)

RULED = f"{EVENT_TRIPS}, {DURATIONS}, {JUDGED}"
FAULTED = f"{FAULTY_TRIPS}, {DURATIONS}, {JUDGED}"

PLACES = """
places AS (
  SELECT CAST(n_nationkey AS BIGINT) AS zone_id,
    CASE n_nationkey WHEN 23 THEN 'Unknown' WHEN 24 THEN 'N/A' ELSE r_name END AS borough,
    n_name || CASE WHEN n_nationkey IN (3, 8, 17) THEN ' Airport' ELSE '' END AS zone,
    CASE WHEN n_nationkey IN (3, 17) THEN 'Airports' WHEN n_nationkey = 8 THEN 'EWR'
         ELSE 'Boro Zone' END AS service_zone,
    n_nationkey IN (3, 8, 17) AS is_airport
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

FEED = """
feed AS (
  SELECT date_trunc('hour', ts) AS label, (count(*) % 8) / 4.0::DOUBLE AS mm,
    min(user_id)::DOUBLE AS temp, CAST(max(user_id) % 100 AS BIGINT) AS code
  FROM events WHERE event_type = 'error' GROUP BY 1
)"""

# January has no clock change: New York is UTC - 5 throughout.
HOURS = f"""
{FEED}, spine AS (
  SELECT g AS hour_key
  FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00', INTERVAL 1 HOUR) s(g)
), hours AS (
  SELECT hour_key, f6.mm AS mm, f5.temp AS temp, f6.code AS code,
    f6.mm >= 0.5 AS rainy, f6.mm >= 1.25 AS rainy_high, f6.mm IS NOT NULL AS has_weather
  FROM spine
  LEFT JOIN feed f6 ON f6.label = hour_key + INTERVAL 6 HOUR
  LEFT JOIN feed f5 ON f5.label = hour_key + INTERVAL 5 HOUR
)"""

ORDER_TRIPS = """
ol0 AS (
  SELECT *, o_orderdate + to_seconds(l_orderkey % 86400) AS request_ts
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
), ol1 AS (
  SELECT *, request_ts + to_minutes(date_diff('day', o_orderdate, l_shipdate)) AS pickup_ts FROM ol0
), trips AS (
  SELECT l_returnflag AS company, request_ts,
    CASE WHEN l_linenumber <> 7 THEN pickup_ts + to_minutes(10 * (l_linenumber - 4)) END
      AS on_scene_ts,
    pickup_ts, pickup_ts + to_hours(CAST(l_quantity AS INT) - 1) AS dropoff_ts,
    o_custkey % 25 AS pu_zone_id, l_suppkey % 25 AS do_zone_id,
    CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice / 1000 END AS trip_miles,
    CAST(l_quantity - 1 AS BIGINT) * 3600 + (l_linenumber - 4) * 60 AS trip_time,
    o_totalprice - l_extendedprice AS fare, l_extendedprice * (l_discount - l_tax) AS pay,
    CASE l_linestatus WHEN 'O' THEN 'Y' ELSE 'N' END AS wav_request,
    CASE l_linenumber % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS wav_match
  FROM ol1
)"""
ORDERED = f"{ORDER_TRIPS}, {DURATIONS}"


_NULL_KEY = " OR ".join(
    f"{c} IS NULL" for c in ("trip_id", "company_id", "pu_zone_id", "request_ts", "pickup_ts"))
_COMPANIES = "'click', 'error', 'purchase', 'signup', 'view', 'lapsed'"


def sql(name: str, body: str, ctes: str = "") -> None:
    ORACLE_SQL[name] = (f"WITH {ctes} " if ctes else "") + body


# ------------------------------------------------------------------ sources and completeness

sql("src1_row_lineage", "SELECT event_id, event_id AS file_row_number FROM events")
sql(
    "src4_weather_unnest",
    f"""SELECT 'GMT' AS timezone, strftime(label, '%Y-%m-%dT%H:%M') AS time_utc,
        {r6('mm', 'precipitation')}, {r6('temp', 'temperature_2m')}, code AS weather_code,
        row_number() OVER (ORDER BY label) - 1 AS position FROM feed""",
    FEED,
)
sql(
    "chk1_hourly_counts",
    "SELECT date_trunc('hour', ts) AS hour, count(*) AS n_rows FROM events GROUP BY 1",
)
SPINE = HOURS.split("), hours AS")[0] + ")"
PER_HOUR = "per_hour AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1)"
sql(
    "chk3_hours_of_month_with_rows",
    """SELECT hour_key + INTERVAL 5 HOUR AS utc_hour, hour_key AS hour, coalesce(n, 0) AS n_rows
       FROM spine LEFT JOIN per_hour ON hour = hour_key""",
    f"{SPINE}, {PER_HOUR}",
)
sql(
    "chk4_zero_hours",
    "SELECT hour_key AS hour FROM spine WHERE hour_key NOT IN (SELECT hour FROM per_hour)",
    f"{SPINE}, {PER_HOUR}",
)
sql(
    "chk5_outside_hours",
    """SELECT date_trunc('hour', dropoff_ts) AS hour, count(*) AS n_rows FROM trips
       WHERE dropoff_ts < TIMESTAMP '2024-01-01' OR dropoff_ts >= TIMESTAMP '2024-02-01'
       GROUP BY 1""",
    EVENT_TRIPS,
)
sql(
    "chk6_thin_hours",
    """SELECT hour, n AS n_rows FROM per_hour
       WHERE n < 0.6::DOUBLE * (SELECT median(n) FROM per_hour)""",
    PER_HOUR,
)
sql(
    "chk8_hourly_summary",
    f"""SELECT {big('sum(n)', 'n_rows')}, min(hour) AS min_hour, max(hour) AS max_hour,
        CAST(744 AS BIGINT) AS expected_hours, count(*) AS hours_with_rows,
        744 - count(*) AS zero_hours, {r6('median(n)', 'median_rows_per_hour')},
        CAST(31 AS BIGINT) AS expected_days, count(DISTINCT CAST(hour AS DATE)) AS days_with_rows,
        CAST(0 AS BIGINT) AS rows_outside_month FROM per_hour""",
    PER_HOUR,
)
sql(
    "chk10_dense_keys",
    """SELECT count(*) AS n_rows, count(DISTINCT n_nationkey) AS n_ids, min(n_nationkey) AS min_id,
        max(n_nationkey) AS max_id, count(*) = 25 AND count(DISTINCT n_nationkey) = 25
        AND min(n_nationkey) = 0 AND max(n_nationkey) = 24 AS is_dense FROM nation""",
)
sql(
    "chk14_weather_feed",
    f"""SELECT count(*) AS expected_local_hours, count(label) AS local_hours_present,
        {n_if('label IS NOT NULL AND mm IS NULL', 'nulls_precipitation')},
        {n_if('label IS NOT NULL AND temp IS NULL', 'nulls_temperature_2m')},
        {n_if('label IS NOT NULL AND code IS NULL', 'nulls_weather_code')},
        (SELECT count(*) FROM feed) AS returned_hours, CAST(0 AS BIGINT) AS rows_in_other_timezone,
        count(label) = count(*) AS contiguous
        FROM spine LEFT JOIN feed ON label = hour_key + INTERVAL 5 HOUR""",
    SPINE,
)
sql(
    "chk15_sanity_band",
    f"""SELECT per_day AS trips_per_day, CAST(31 AS BIGINT) AS days, per_day * 31 AS expected_rows,
        n AS actual_rows, n - per_day * 31 AS delta,
        {r6('abs(n - per_day * 31)::DOUBLE / (per_day * 31)', 'delta_share')},
        CASE WHEN abs(n - per_day * 31)::DOUBLE / (per_day * 31) <= 0.01 THEN 'within_band'
             ELSE 'outside_band' END AS status FROM counted""",
    """counted AS (SELECT CAST(floor(count(*) FILTER (event_type = 'view') * 5 / 31) AS BIGINT)
        AS per_day, count(*) AS n FROM events)""",
)
sql(
    "chk16_row_counts",
    """SELECT a AS rows_a, b AS rows_b, a = b AS equal
       FROM (SELECT count(*) AS a, (SELECT count(*) FROM events) AS b FROM trips)""",
    EVENT_TRIPS,
)
sql(
    "chk17_reconciliation",
    f"""SELECT (SELECT count(*) FROM events) AS rows_in, {n_if('NOT rejected', 'rows_clean')},
        {n_if('rejected', 'rows_quarantined')},
        count(*) FILTER (rejected) + count(*) FILTER (NOT rejected)
          = (SELECT count(*) FROM events) AS reconciles FROM judged""",
    RULED,
)
sql(
    "chk23_headline",
    f"""SELECT {r6('avg(CAST(wait > 10 AS INT))', 'kpi')}, TRUE AS kpi_is_share,
        '' AS missing_families FROM kept WHERE wait_ok""",
    RULED,
)
sql(
    "chk26_same_content",
    """SELECT count(*) AS rows_a, count(*) AS rows_b, NOT bool_or(o_orderkey % 100 = 0
        AND o_orderpriority IS DISTINCT FROM '0') AS identical FROM orders""",
)
sql(
    "chk26_row_differences",
    """SELECT CASE WHEN l_linenumber < 2 THEN 'only_a' ELSE 'only_b' END AS side, l_returnflag,
        l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem
        WHERE l_linenumber < 2 OR l_linenumber > 5 GROUP BY ALL""",
)

# ------------------------------------------------------------------ derived columns, duplicates

sql(
    "prj_durations",
    f"""SELECT trip_id, {r6('wait', 'wait_minutes')}, {r6('dwell', 'dwell_minutes')},
        {r6('trip_time / 60.0', 'trip_minutes')}, {r6('ride / 60', 'timestamp_trip_minutes')},
        {r6('trip_time - ride', 'duration_gap_seconds')}, {r6('mph', 'speed_mph')},
        {r6('approach', 'request_to_arrival_minutes')} FROM timed""",
    f"{EVENT_TRIPS}, {DURATIONS}",
)
COPIES = """copies AS (
  SELECT *, row_number() OVER (same ORDER BY doc_id) AS dup_rank, count(*) OVER (same) AS dup_count
  FROM documents WINDOW same AS (PARTITION BY text, lang, source, n_chars)
)"""
sql("wn1_exact_duplicates", "SELECT doc_id, dup_rank, dup_count FROM copies", COPIES)
sql(
    "ag5_exact_quantiles",
    "SELECT l_returnflag, l_linestatus, "
    + ", ".join(
        r6(f"quantile_cont(l_extendedprice * (1 - l_discount), {q})", a)
        for a, q in (("p1", 0.01), ("p50", 0.5), ("p90", 0.9), ("p99", 0.99))
    )
    + ", "
    + r6("median(CASE WHEN l_tax > 0.05::DOUBLE THEN l_quantity END)", "median_taxed_quantity")
    + " FROM lineitem GROUP BY ALL",
)

# ------------------------------------------------------------------ profiles


def quantile_list(column: str, levels: dict[str, float]) -> str:
    return ", ".join(r6(f"quantile_cont({column}, {q})", a) for a, q in levels.items())


WAIT_LEVELS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9,
               "p99": 0.99, "p99_9": 0.999}
_WAIT_COLUMNS = f"""count(*) AS n, {quantile_list('wait', WAIT_LEVELS)}, {r6('max(wait)', 'max')},
    {r6('min(wait)', 'min')}"""
sql(
    "pf1_wait_percentiles",
    f"""SELECT company, FALSE AS is_total, {_WAIT_COLUMNS} FROM timed GROUP BY company
        UNION ALL SELECT 'ALL', TRUE, {_WAIT_COLUMNS} FROM timed""",
    ORDERED,
)
sql(
    "pf2_wait_tail",
    f"""SELECT {quantile_list('wait', {'p99_99': 0.9999, 'p99_999': 0.99999})},
        {', '.join(n_if(f'wait > {x}', f'over_{x}') for x in (60, 120, 180, 300, 1000))},
        {n_if("wait > 180 AND company = 'R'", 'over_180_company_r')} FROM timed""",
    ORDERED,
)
sql(
    "pf3_wait_log_histogram",
    f"""SELECT {big('floor(20 * log10(wait))', 'bin_k')}, count(*) AS n FROM timed
        WHERE wait > 0 GROUP BY 1""",
    ORDERED,
)
sql(
    "pf4_negative_wait_by_segment",
    f"""SELECT company, wav_request, wav_match, count(*) AS n, {n_if('wait < 0', 'negative_wait')},
        {pct('wait < 0', 'pct_negative')},
        {n_if('on_scene_ts < request_ts', 'on_scene_before_request')},
        {pct('on_scene_ts < request_ts', 'pct_on_scene_before_request')},
        {n_if('wait < 0 AND on_scene_ts < request_ts', 'both_signals')},
        {r6('median(CASE WHEN wait < 0 THEN wait END)', 'median_negative_wait')}
        FROM timed GROUP BY company, wav_request, wav_match""",
    ORDERED,
)
sql(
    "pf5_negative_wait_vs_on_scene",
    """SELECT wait < 0 AS negative_wait, on_scene_ts < request_ts AS on_scene_before_request,
        count(*) AS n FROM timed GROUP BY 1, 2""",
    ORDERED,
)
sql(
    "pf6_prearranged_signature",
    f"""SELECT grp, count(*) AS n, {pct("zone LIKE '%Airport%'", 'pct_dropoff_airport')},
        {pct('second(request_ts) = 0', 'pct_whole_minute_request')},
        {r6('median(trip_miles)', 'median_miles')}, {r6('median(dwell)', 'median_dwell')}
        FROM (SELECT *, CASE
            WHEN on_scene_ts < request_ts AND wait < 0 THEN 'a negative wait + on_scene < request'
            WHEN on_scene_ts < request_ts THEN 'b wait >= 0 + on_scene < request'
            WHEN wait < 0 THEN 'c negative wait only' ELSE 'd other trips' END AS grp FROM timed)
        LEFT JOIN places ON zone_id = do_zone_id GROUP BY grp""",
    f"{ORDERED}, {PLACES}",
)
sql(
    "pf7_prearranged_by_hour",
    f"""SELECT {big('hour(pickup_ts)', 'pickup_hour')}, count(*) AS n,
        {pct('on_scene_ts < request_ts', 'pct_on_scene_before_request')},
        {pct('wait < 0', 'pct_negative_wait')} FROM timed GROUP BY 1""",
    ORDERED,
)
sql(
    "pf8_whole_minute_request_by_wait",
    f"""SELECT company, wait_band, count(*) AS n,
        {pct('second(request_ts) = 0', 'pct_whole_minute_request')},
        {pct('on_scene_ts < request_ts', 'pct_on_scene_before_request')}
        FROM (SELECT *, CASE WHEN wait >= 180 THEN 'g 180+' WHEN wait >= 60 THEN 'f 60-180'
            WHEN wait >= 30 THEN 'e 30-60' WHEN wait >= 20 THEN 'd 20-30'
            WHEN wait >= 10 THEN 'c 10-20' WHEN wait >= 0 THEN 'b 0-10' ELSE 'a <0' END
            AS wait_band FROM timed) GROUP BY company, wait_band""",
    ORDERED,
)
sql(
    "pf9_on_scene_vs_pickup",
    f"""SELECT company, count(*) AS n, {pct('on_scene_ts IS NULL', 'pct_on_scene_null')},
        {pct('on_scene_ts = pickup_ts', 'pct_on_scene_eq_pickup')},
        {pct('on_scene_ts > pickup_ts', 'pct_on_scene_after_pickup')},
        {pct('on_scene_ts < pickup_ts', 'pct_dwell_measurable')} FROM timed GROUP BY company""",
    ORDERED,
)
sql(
    "pf10_dwell_where_measurable",
    f"""SELECT company, count(*) AS n,
        {quantile_list('dwell', {'p25': .25, 'p50': .5, 'p75': .75, 'p90': .9, 'p99': .99})},
        {r6('max(dwell)', 'max')} FROM timed WHERE on_scene_ts < pickup_ts GROUP BY company""",
    ORDERED,
)
sql(
    "pf11_implied_speed",
    f"""SELECT {n_if('trip_time = 0', 'trip_time_zero')},
        {quantile_list('mph', {'p50': .5, 'p90': .9, 'p99': .99, 'p99_9': .999, 'p99_99': .9999})},
        {r6('max(mph)', 'max')},
        {', '.join(n_if(f'mph > {x}', f'over_{x}') for x in (55, 65, 100))} FROM timed""",
    ORDERED,
)
sql(
    "pf12_implied_speed_bins",
    f"""SELECT {r6('5 * floor(mph / 5)', 'mph_bin_lo')}, count(*) AS n FROM timed
        WHERE mph BETWEEN 40 AND 100 AND mph <> 100 GROUP BY 1""",
    ORDERED,
)
sql(
    "pf13_timestamp_speed_check",
    f"""SELECT count(*) AS n_over_65_by_timestamps,
        {r6('median(ride)', 'median_timestamp_seconds')},
        {r6('median(trip_time)', 'median_trip_time_seconds')}
        FROM timed WHERE ride > 0 AND trip_miles / (ride / 60 / 60.0) > 65""",
    ORDERED,
)
sql(
    "pf14_duration_agreement",
    f"""SELECT {n_if('abs(trip_time - ride) > 120', 'gap_over_120s')},
        {pct('abs(trip_time - ride) > 120', 'pct_gap_over_120s')},
        {r6('median(trip_time - ride)', 'median_gap_seconds')},
        {r6('quantile_cont(abs(trip_time - ride), 0.99)', 'p99_abs_gap_seconds')} FROM timed""",
    ORDERED,
)
sql(
    "pf15_duplicates",
    f"""SELECT (SELECT count(*) FROM copies WHERE dup_rank > 1) AS exact_duplicate_extra_rows,
        (SELECT count(*) FROM copies WHERE dup_count > 1) AS rows_in_exact_duplicate_groups,
        count(*) AS business_key_groups_with_collision,
        {big('coalesce(sum(c - 1), 0)', 'business_key_extra_rows')},
        {n_if('k > 1', 'collision_groups_with_distinct_requests')}
        FROM (SELECT count(*) AS c, count(DISTINCT text) AS k FROM documents
              GROUP BY lang, n_chars HAVING count(*) > 1)""",
    COPIES,
)
sql(
    "pf16_other_counts",
    f"""SELECT count(*) AS n, {n_if('trip_miles = 0', 'trip_miles_zero')},
        {n_if('trip_miles = 0 AND trip_time > 60', 'miles_zero_time_over_60s')},
        {n_if('pay < 0', 'driver_pay_negative')}, {n_if('fare < 0', 'fare_negative')},
        {n_if('pu_zone_id = 23', 'pickup_zone_23')}, {n_if('pu_zone_id = 24', 'pickup_zone_24')},
        {pct('pu_zone_id >= 23', 'pct_pickup_unknown')},
        {n_if('do_zone_id >= 23', 'dropoff_zone_unknown')},
        {n_if('dropoff_ts <= pickup_ts', 'dropoff_not_after_pickup')},
        {n_if("pickup_ts < TIMESTAMP '2024-01-01' OR pickup_ts >= TIMESTAMP '2024-02-01'",
              'pickup_outside_month')} FROM timed""",
    ORDERED,
)
ORDER_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
sql(
    "pf17_column_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type,
        (SELECT CAST(min({c}) AS VARCHAR) FROM orders) AS min,
        (SELECT CAST(max({c}) AS VARCHAR) FROM orders) AS max,
        (SELECT 100.0 * sum(({c} IS NULL)::INT) / count(*) FROM orders)::DOUBLE AS null_pct,
        (SELECT count(DISTINCT {c}) FROM orders) AS n_distinct,
        (SELECT string_agg(coalesce(v, 'NULL') || ' (' || c || ')', '; ' ORDER BY c DESC,
                v NULLS FIRST)
         FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS c FROM orders GROUP BY 1
               ORDER BY c DESC, v NULLS FIRST LIMIT 5)) AS top_values"""
        for c, kind in ORDER_COLUMNS.items()
    ),
)

# ------------------------------------------------------------------ rules

sql(
    "vr2_rule_hits",
    "SELECT trip_id, " + ", ".join(f"{r} AS hit_{r}" for r in RULE_TESTS) + " FROM judged",
    RULED,
)
_FLAGS = ", ".join(f"{r} AS flag_{r}" for r in FLAG_IDS)
sql(
    "vr4_quarantine",
    f"""SELECT trip_id, filed AS rule_id, all_filed AS reject_rules, {_FLAGS}
        FROM judged WHERE rejected""",
    RULED,
)
sql(
    "vr5_clean",
    f"SELECT trip_id, {r6('wait', 'wait_minutes')}, {_FLAGS}, dup_count > 1 AS flag_r05_survivor FROM kept",
    RULED,
)


def _rule_row(r: str) -> str:
    if r in REJECT_IDS:
        rows, overlap, excludes = f"filed = '{r.upper()}'", f"count(*) FILTER ({r})", "NULL"
    else:
        rows, overlap = f"{r} AND NOT rejected", "CAST(NULL AS BIGINT)"
        excludes = f"'{EXCLUDED[r]}'" if r in EXCLUDED else "NULL"
    severity = "REJECT" if r in REJECT_IDS else "FLAG"
    return f"""SELECT '{r.upper()}' AS rule_id, '{severity}' AS severity,
        '{RULE_NAMES[r]}' AS name, count(*) FILTER ({rows}) AS rows,
        {r6(f'100.0 * count(*) FILTER ({rows}) / count(*)', 'pct_of_rows_in')},
        {overlap} AS rows_matching_incl_overlaps, CAST({excludes} AS VARCHAR) AS excludes
        FROM judged"""


def _survivors() -> str:
    kept = "NOT rejected AND dup_count > 1"
    return f""" UNION ALL SELECT 'R05s', 'FLAG', 'survivor of an exact duplicate (kept copy)',
        count(*) FILTER ({kept}), {r6(f'100.0 * count(*) FILTER ({kept}) / count(*)', 'pct')},
        NULL, NULL FROM judged"""


sql(
    "vr8_rule_counts",
    " UNION ALL ".join(_rule_row(r) for r in RULE_TESTS)
    + _survivors(),
    RULED,
)
sql(
    "vr9_trust_lines",
    f"""SELECT rows_in, t AS trusted_rows, {r6('t / rows_in', 'trusted_row_share')},
        w AS wait_eligible_rows, {r6('w / rows_in', 'wait_eligible_share')},
        d AS dwell_rows, {r6('d / rows_in', 'dwell_coverage')}
        FROM (SELECT count(*) AS rows_in, count(*) FILTER (NOT rejected) AS t,
              count(*) FILTER (NOT rejected AND wait_ok) AS w,
              count(*) FILTER (NOT rejected AND dwell_ok) AS d FROM judged)""",
    RULED,
)


def _variant(label: str, condition: str) -> str:
    rates = ", ".join(
        r6(f"100 * avg(CAST(wait > {x} AS INT))", f"late_rate_{k}_pct")
        for k, x in (("low", 8), ("main", 10), ("high", 15))
    )
    return f"""SELECT '{label}' AS variant, count(*) AS n, {rates} FROM judged WHERE {condition}"""


sql(
    "vr10_kpi_variants",
    " UNION ALL ".join(
        [
            _variant("a headline: clean, excluding pre-arranged (R12)", "NOT rejected AND wait_ok"),
            _variant(
                "b if R03 rejects were kept",
                "wait_ok AND (NOT rejected OR (filed = 'R03' AND n_filed = 1))",
            ),
            _variant("c if pre-arranged (R12) rows were kept as measured", "NOT rejected"),
            _variant(
                "d also excluding whole-minute requests (R14)",
                "NOT rejected AND wait_ok AND NOT r14",
            ),
        ]
    ),
    RULED,
)
sql(
    "vr11_kpi_by_segment",
    f"""SELECT company_id AS company, CASE WHEN wav THEN 'Y' ELSE 'N' END AS wav_request,
        count(*) AS clean_rows, {n_if('wait_ok', 'rows_in_wait_metrics')},
        {pct('wait_ok', 'wait_coverage_pct')},
        {r6('100 * avg(CASE WHEN wait_ok THEN CAST(wait > 10 AS INT) END)', 'late_rate_pct')}
        FROM kept GROUP BY 1, 2""",
    RULED,
)
sql(
    "vr12_promotion_check",
    f"""SELECT w AS whole_minute_rows, {r6('round(n / 60.0)', 'expected_by_chance')},
        {r6('w - round(n / 60.0)', 'excess_over_chance')}, {r6('a', 'late_rate_flagged')},
        {r6('b', 'late_rate_rest')}, {r6('a / nullif(b, 0)', 'ratio')},
        CASE WHEN a / nullif(b, 0) IS NULL THEN 'cannot be computed'
             WHEN round(a / b, 2) > 2 THEN 'above the bar' ELSE 'below the bar' END AS verdict
        FROM (SELECT count(*) AS n, count(*) FILTER (r14) AS w,
              avg(CASE WHEN r14 THEN CAST(wait > 10 AS INT) END) AS a,
              avg(CASE WHEN NOT r14 THEN CAST(wait > 10 AS INT) END) AS b
              FROM kept WHERE wait_ok)""",
    RULED,
)

# ------------------------------------------------------------------ star schema

sql(
    "md1_dim_zone",
    """SELECT zone_id, borough, zone, service_zone, zone_id >= 23 AS is_unknown, is_airport,
        'nation and region' AS source FROM places""",
    PLACES,
)
sql(
    "md2_dim_company_trips",
    """SELECT k AS company_id, upper(k[1]) || k[2:] || ' cars' AS company_name,
        'event types' AS source, (SELECT count(*) FROM kept WHERE company_id = k) AS trips
        FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('lapsed')) v(k)""",
    RULED,
)
sql(
    "md3_dim_base",
    """SELECT base_id, CAST(NULL AS VARCHAR) AS base_name,
        'trip file (names unavailable)' AS source
        FROM (SELECT base_id FROM kept UNION SELECT originating_base_id FROM kept
              WHERE originating_base_id IS NOT NULL)""",
    RULED,
)
sql(
    "md4_dim_hour",
    f"""SELECT hour_key, CAST(hour_key AS DATE) AS hour_date, {big('isodow(hour_key)', 'dow')},
        dayname(hour_key) AS dow_name, {big('hour(hour_key)', 'hour_of_day')},
        {r6('mm', 'precipitation_mm')}, {r6('temp', 'temperature_c')}, code AS weather_code,
        rainy AS is_rainy, rainy_high AS is_rainy_moderate, has_weather AS weather_available
        FROM hours""",
    HOURS,
)
sql(
    "md5_fact_trip",
    f"""SELECT trip_id AS trip_key, company_id, base_id, originating_base_id, pu_zone_id,
        do_zone_id, request_ts, on_scene_ts, pickup_ts, dropoff_ts,
        date_trunc('hour', request_ts) AS request_hour_key,
        {big('isodow(request_ts)', 'request_dow')}, {big('hour(request_ts)', 'request_hour')},
        {r6('wait', 'wait_minutes')}, {r6('approach', 'request_to_arrival_minutes')},
        {r6('dwell', 'dwell_minutes')}, {r6('trip_time / 60.0', 'trip_minutes')},
        {r6('ride / 60', 'timestamp_trip_minutes')}, {r6('trip_miles', 'trip_miles')},
        {r6('pay', 'driver_pay')}, {r6('fare', 'base_passenger_fare')},
        wait > 8 AS is_late_8, wait > 10 AS is_late_10, wait > 15 AS is_late_15,
        shared AS shared_request, wav AS wav_request, wav_matched AS wav_match,
        assisted AS access_a_ride, {_FLAGS}, dup_count > 1 AS flag_r05_survivor FROM kept""",
    RULED,
)
WORKFLOW = """steps AS (
  SELECT trip_id, 1::BIGINT AS o, 'requested' AS kind, request_ts AS moment, 'request' AS src FROM kept
  UNION ALL SELECT trip_id, 2, 'on_scene', on_scene_ts, 'on_scene' FROM kept WHERE dwell_ok
  UNION ALL SELECT trip_id, 3, 'picked_up', pickup_ts, 'pickup' FROM kept
  UNION ALL SELECT trip_id, 4, 'dropped_off', dropoff_ts, 'dropoff' FROM kept
)"""
sql(
    "md6_fact_trip_event",
    """SELECT trip_id AS trip_key, o AS event_order, kind AS event_type, moment AS event_ts,
        src || '_datetime' AS event_source FROM steps""",
    f"{RULED}, {WORKFLOW}",
)
sql(
    "md7_time_in_state",
    f"""SELECT trip_id AS trip_key, o AS event_order, kind AS event_type, moment AS event_ts,
        {r6("date_diff('microsecond', lag(moment) OVER (PARTITION BY trip_id ORDER BY o), moment) / 6e7",
            'minutes_since_previous')} FROM steps""",
    f"{RULED}, {WORKFLOW}",
)
sql(
    "md8_star_statistics",
    f"""SELECT (SELECT count(*) FROM kept) AS fact_rows,
        (SELECT count(*) FROM kept WHERE {_NULL_KEY}) AS fact_rows_with_null_key,
        (SELECT count(*) FROM kept WHERE dwell_ok) AS captured_arrivals,
        (SELECT count(*) FROM kept WHERE company_id NOT IN ({_COMPANIES}))
          AS rows_with_unknown_company, count(*) AS hours,
        {n_if('has_weather', 'hours_with_weather')}, {n_if('rainy', 'wet_hours')},
        (SELECT count(*) FROM kept) AS clean_rows, (SELECT count(*) FROM steps) AS event_rows
        FROM hours""",
    f"{RULED}, {WORKFLOW}, {HOURS}",
)

# ------------------------------------------------------------------ metrics


def line(
    metric: str, grain: str, dims: str, value: str, n: str, note: str, source: str
) -> str:
    return f"""SELECT {metric} AS metric, {grain} AS grain, {dims} AS dimensions,
        {r6(value, 'value')}, {big(n, 'n')}, {note} AS note FROM {source}"""


LATE = "avg(CAST(wait > {} AS INT))"
NONE = "CAST(NULL AS VARCHAR)"
M1A = " UNION ALL ".join(
    line(f"'M1_late_rate_{x}'", "'month'", "''", LATE.format(x), "count(*)", NONE,
         "kept WHERE wait_ok")
    for x in (8, 10, 15)
)
M1B = " UNION ALL ".join(
    [
        line("'M1_late_rate_10'", "'month'", "'variant=pre-arranged kept as measured'",
             LATE.format(10), "count(*)", "'sensitivity: R12 exclusion undone'", "kept"),
        line("'M1_late_rate_10'", "'month'", "'variant=whole-minute requests dropped'",
             LATE.format(10), "count(*)", "'sensitivity: R14 rows also excluded'",
             "kept WHERE wait_ok AND NOT r14"),
    ]
)
_SEGMENT = "'company=' || company_id || '|wav_request=' || wav"
M1C = " UNION ALL ".join(
    [
        line("'M1_late_rate_10'", "'company x wav_request'", _SEGMENT, LATE.format(10),
             "count(*)", NONE, "kept WHERE wait_ok GROUP BY company_id, wav"),
        line("'M5_wait_coverage'", "'company x wav_request'", _SEGMENT,
             "avg(CAST(wait_ok AS INT))", "count(*)",
             "'share of clean rows that enter wait metrics'", "kept GROUP BY company_id, wav"),
    ]
)
M1D = line(
    "'M1_late_rate_10'", "'borough x hour_of_day'",
    "'borough=' || borough || '|hour=' || lpad(CAST(hour(request_ts) AS VARCHAR), 2, '0')",
    LATE.format(10), "count(*)", NONE,
    """kept JOIN places ON zone_id = pu_zone_id WHERE wait_ok AND NOT r08
       GROUP BY borough, hour(request_ts)""",
)
M2 = line("'M2_p90_wait_minutes'", "'month'", "''", "quantile_cont(wait, 0.9)", "count(*)", NONE,
          "kept WHERE wait_ok")
M3 = " UNION ALL ".join(
    [
        line("'M3_median_dwell_minutes'", "'company'", "'company=' || company_id",
             "median(dwell)", "count(*)", NONE, "kept WHERE dwell_ok GROUP BY company_id"),
        line("'M3_dwell_coverage'", "'company'", "'company=' || company_id",
             "avg(CAST(dwell_ok AS INT))", "count(*)",
             "'share of clean rows with on_scene < pickup'", "kept GROUP BY company_id"),
    ]
)
RAINFALL = """wet0 AS (
  SELECT CAST(wait > 10 AS INT) AS late, hour(request_ts) AS h, borough, rainy, rainy_high
  FROM kept JOIN hours ON hour_key = date_trunc('hour', request_ts)
  JOIN places ON zone_id = pu_zone_id WHERE wait_ok AND has_weather
), wet AS (
  SELECT late, h, thr, wet, scope FROM (
    SELECT late, h, borough, unnest([{'thr': '0.5', 'wet': rainy}, {'thr': '1.25', 'wet':
        rainy_high}], recursive := true) FROM wet0
  ), (SELECT unnest(['city', 'own']) AS kind), LATERAL (
    SELECT CASE kind WHEN 'city' THEN 'all' ELSE borough END AS scope)
  WHERE scope NOT IN ('Unknown', 'N/A')
), sides AS (
  SELECT thr, scope, avg(CASE WHEN wet THEN late END) AS rr, avg(CASE WHEN NOT wet THEN late END)
    AS rd, count(CASE WHEN wet THEN 1 END) AS nr, count(CASE WHEN NOT wet THEN 1 END) AS nd
  FROM wet GROUP BY thr, scope
), by_hour AS (
  SELECT thr, scope, h, avg(CASE WHEN wet THEN late END) - avg(CASE WHEN NOT wet THEN late END)
    AS gap, count(CASE WHEN wet THEN 1 END) AS nr
  FROM wet GROUP BY thr, scope, h
)"""
RAINED = f"{RULED}, {PLACES}, {HOURS}, {RAINFALL}"
_GRAIN = "CASE scope WHEN 'all' THEN 'month' ELSE 'borough' END"
_THR = "'threshold_mm=' || thr || CASE scope WHEN 'all' THEN '' ELSE '|borough=' || scope END"
M4A = " UNION ALL ".join(
    [
        line("'M4_rain_minus_dry_late_rate'", _GRAIN, _THR, "rr - rd", "nr + nd",
             "'raw difference'", "sides"),
        line("'M4_late_rate_rainy'", _GRAIN, _THR, "rr", "nr", NONE, "sides"),
        line("'M4_late_rate_dry'", _GRAIN, _THR, "rd", "nd", NONE, "sides"),
    ]
)
M4B = line(
    "'M4_rain_minus_dry_late_rate_hour_adjusted'", _GRAIN, _THR, "sum(gap * nr) / sum(nr)",
    "sum(nr)", "'within hour of day, weighted by rainy trips'",
    "by_hour WHERE gap IS NOT NULL GROUP BY thr, scope",
)
M4C = " UNION ALL ".join(
    line("'M4_wet_hours'", "'month'", f"'threshold_mm={mm}'", f"count(CASE WHEN {c} THEN 1 END)",
         "count(*)", "'hours of the month at or above threshold'", "hours WHERE has_weather")
    for mm, c in (("0.5", "rainy"), ("1.25", "rainy_high"))
)
M5 = " UNION ALL ".join(
    [
        *[
            line(f"'{metric}'", "'month'", "''", f"avg(CAST({c} AS INT))", "count(*)",
                 f"'{note}'", "judged")
            for metric, c, note in (
                ("M5_trusted_row_share", "NOT rejected", "not quarantined"),
                ("M5_wait_eligible_share", "(NOT rejected AND wait_ok)", "rows that enter the KPI"),
                ("M5_dwell_coverage", "(NOT rejected AND dwell_ok)",
                 "rows with on_scene < pickup"),
            )
        ],
        line("'M5_rule_share'", "'rule'", "'rule_id=' || filed || '|severity=REJECT'",
             "count(*) / (SELECT count(*) FROM judged)", "count(*)", "'primary reject rule'",
             "judged WHERE rejected GROUP BY filed"),
    ]
)
sql("m1a_late_rate", M1A, RULED)
sql("m1b_late_rate_sensitivity", M1B, RULED)
sql("m1c_late_rate_company_wav", M1C, RULED)
sql("m1d_late_rate_borough_hour", M1D, f"{RULED}, {PLACES}")
sql("m2_p90_wait", M2, RULED)
sql("m3_dwell", M3, RULED)
sql("m4a_rain", M4A, RAINED)
sql("m4b_rain_hour_adjusted", M4B, RAINED)
sql("m4c_wet_hours", M4C, HOURS)
sql("m5_trust", M5, RULED)

ALL_METRICS = " UNION ALL ".join([M1A, M1B, M1C, M1D, M2, M3, M4A, M4B, M4C, M5])
METRICS = f"metrics AS (SELECT * REPLACE (coalesce(note, '') AS note) FROM ({ALL_METRICS}))"
MEASURED = f"{RAINED}, {METRICS}"
sql("mx2_metric_table", "SELECT * FROM metrics", MEASURED)
_NO_WEATHER = " UNION ALL ".join(
    f"""SELECT '{m}', 'month', '', CAST(NULL AS DOUBLE), CAST(0 AS BIGINT),
        'UNAVAILABLE (no weather data: --no-weather or source failed)'"""
    for m in (
        "M4_rain_minus_dry_late_rate",
        "M4_rain_minus_dry_late_rate_hour_adjusted",
        "M4_late_rate_rainy",
        "M4_late_rate_dry",
        "M4_wet_hours",
    )
)
sql(
    "mx1_metrics_without_weather",
    f"SELECT * FROM metrics WHERE metric NOT LIKE 'M4%' UNION ALL {_NO_WEATHER}",
    MEASURED,
)
sql(
    "hg1_kpi_wait_histogram",
    f"""SELECT {big('floor(20 * log10(wait))', 'bin_k')}, count(*) AS n FROM kept
        WHERE wait_ok AND wait > 0 GROUP BY 1""",
    RULED,
)

# ------------------------------------------------------------------ cells

CELLS = f"""
{PLACES}, ranked_trips AS (
  SELECT *, isodow(request_ts) AS dow, hour(request_ts) AS hour,
    CASE WHEN dwell_ok THEN approach END AS seen_approach,
    CASE WHEN dwell_ok THEN dwell END AS seen_dwell
  FROM kept WHERE wait_ok AND NOT r08
), zone_medians AS (
  SELECT pu_zone_id AS z, median(seen_approach) AS zone_approach FROM ranked_trips GROUP BY 1
), stats AS (
  SELECT pu_zone_id, dow, hour, count(*) AS n, sum(CAST(wait > 10 AS INT)) AS late_trips,
    avg(CAST(wait > 10 AS INT)) AS late_rate, quantile_cont(wait, 0.9) AS p90,
    median(seen_approach) AS approach, median(seen_dwell) AS dwell
  FROM ranked_trips GROUP BY pu_zone_id, dow, hour
), scored AS (
  SELECT stats.*, borough, zone, is_airport, zone_approach, city,
    CASE WHEN is_airport THEN 'airport' ELSE 'neighbourhood' END AS list,
    late_rate - city AS over, (late_rate - city) * n AS excess, n >= 4 AS eligible
  FROM stats JOIN places ON zone_id = pu_zone_id JOIN zone_medians ON z = pu_zone_id,
    (SELECT avg(CAST(wait > 10 AS INT)) AS city FROM kept WHERE wait_ok)
), cells AS (
  SELECT *, CASE WHEN eligible THEN row_number() OVER (PARTITION BY eligible, list
      ORDER BY excess DESC, pu_zone_id, dow, hour) END AS rank,
    CASE WHEN eligible THEN row_number() OVER (PARTITION BY eligible
      ORDER BY excess DESC, pu_zone_id, dow, hour) END AS overall_rank
  FROM scored
)"""
RANKED = f"{RULED}, {CELLS}"
sql(
    "ce1_city_rate",
    f"SELECT {r6('avg(CAST(wait > 10 AS INT))', 'city_late_rate')} FROM kept WHERE wait_ok",
    RULED,
)
sql(
    "ce2_zone_baseline",
    f"""SELECT z AS pu_zone_id, {r6('zone_approach', 'zone_median_request_to_arrival_minutes')}
        FROM zone_medians""",
    RANKED,
)
_CELL_QUANTILES = f"""{r6('p90', 'p90_wait_minutes')},
    {r6('approach', 'median_request_to_arrival_minutes')}"""
sql(
    "ce3_cell_statistics",
    f"""SELECT pu_zone_id, dow, hour, n, {big('late_trips', 'late_trips')},
        {r6('late_rate', 'late_rate')}, {_CELL_QUANTILES}, {r6('dwell', 'median_dwell_minutes')}
        FROM stats""",
    RANKED,
)
sql(
    "ce5_cell_ranking",
    f"""SELECT pu_zone_id, dow, hour, list, eligible, rank, overall_rank, n,
        {r6('excess', 'excess_late_trips')} FROM cells""",
    RANKED,
)
sql(
    "ce6_eligible_cells",
    f"""SELECT list, rank, overall_rank, is_airport, borough, zone, pu_zone_id, dow, hour, n,
        {big('late_trips', 'late_trips')}, {r6('late_rate', 'late_rate')},
        {r6('city', 'city_late_rate')}, {r6('over', 'late_rate_excess')},
        {r6('excess', 'excess_late_trips')}, {_CELL_QUANTILES},
        {r6('zone_approach', 'zone_median_request_to_arrival_minutes')},
        {r6('dwell', 'median_dwell_minutes')} FROM cells WHERE eligible""",
    RANKED,
)

# ------------------------------------------------------------------ sampling

HITS = "hits AS (" + " UNION ALL ".join(
    f"SELECT trip_id, '{r.upper()}' AS rule_id FROM judged WHERE {r}" for r in RULE_TESTS
) + ")"


def picked(modulus: int) -> str:
    return f"""picked AS (SELECT trip_id, company_id FROM trips WHERE md5_number(concat_ws('|',
        company_id, base_id, pickup_ts, dropoff_ts, pu_zone_id, do_zone_id, trip_miles))
        % {modulus} = 0)"""


sql("smp1_hash_sample", "SELECT * FROM picked", f"{EVENT_TRIPS}, {picked(10)}")
sql("smp2_rule_hits", "SELECT * FROM hits", f"{RULED}, {HITS}")
COUNTED = f"""{RULED}, {HITS}, {picked(40)}, counted AS (
  SELECT rule_id, count(*) AS month_rows,
    count(*) FILTER (trip_id IN (SELECT trip_id FROM picked)) AS sample_rows
  FROM hits GROUP BY rule_id
)"""
sql("smp5_rule_counts_month_and_sample", "SELECT * FROM counted", COUNTED)

_IN_ORDER = ", ".join(f"({i + 1}, '{r.upper()}')" for i, r in enumerate(RULE_TESTS))
# one step per rule: the five lowest rows of a rule the sample lacks that no earlier rule took
TOPPED_UP = COUNTED.replace("ev0 AS", "RECURSIVE ev0 AS", 1) + f""", absent AS (
  SELECT i, hits.trip_id FROM hits JOIN counted USING (rule_id)
  JOIN (VALUES {_IN_ORDER}) v(i, rule_id) USING (rule_id) WHERE sample_rows = 0
), walk AS (
  SELECT 0 AS i, CAST([] AS BIGINT[]) AS taken, CAST([] AS BIGINT[]) AS got
  UNION ALL
  SELECT i + 1, list_concat(taken, fresh), fresh FROM (
    SELECT i, taken, coalesce((SELECT list(a.trip_id ORDER BY a.trip_id)[1:5] FROM absent a
      WHERE a.i = walk.i + 1 AND NOT list_contains(walk.taken, a.trip_id)), []) AS fresh
    FROM walk WHERE i < 14)
)"""
sql(
    "smp3_rare_rule_sample",
    f"""SELECT trip_id, CAST(NULL AS VARCHAR) AS appended_for FROM picked UNION ALL
        SELECT unnest(got), rule_id FROM walk JOIN (VALUES {_IN_ORDER}) v(i, rule_id) USING (i)""",
    TOPPED_UP,
)

# ------------------------------------------------------------------ inspection and report frames

sql(
    "ins1_rule_examples",
    f"""SELECT trip_id, company_id, request_ts, on_scene_ts, pickup_ts, pu_zone_id,
        {r6('wait', 'wait_minutes')} FROM judged WHERE r03 ORDER BY trip_id LIMIT 20""",
    RULED,
)
sql(
    "ins1_rule_example_totals",
    """SELECT 'R01' AS rule_id, count(*) AS total_rows FROM judged WHERE r01
       UNION ALL SELECT 'R12', count(*) FROM kept WHERE r12""",
    RULED,
)
sql("ins2_month_lines", "SELECT * FROM metrics WHERE grain = 'month'", MEASURED)
_DAY_HOUR = """['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][dow] || ' '
    || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS day_hour"""
sql(
    "rp2_top_neighbourhood_cells",
    f"""SELECT rank, borough, zone, {_DAY_HOUR}, {r6('late_rate', 'late_rate')},
        {r6('over', 'late_rate_excess')}, n, {r6('excess', 'excess_late_trips')},
        {r6('p90', 'p90_wait_minutes')} FROM cells WHERE list = 'neighbourhood' AND rank <= 10""",
    RANKED,
)
sql(
    "rp2_top_airport_cells",
    f"""SELECT rank, zone, {_DAY_HOUR}, {r6('late_rate', 'late_rate')}, n,
        {r6('excess', 'excess_late_trips')},
        {r6('approach', 'median_request_to_arrival_minutes')},
        {r6('zone_approach', 'zone_median_request_to_arrival_minutes')},
        {r6('dwell', 'median_dwell_minutes')} FROM cells WHERE list = 'airport' AND rank <= 5""",
    RANKED,
)
sql(
    "rp3_airport_share",
    f"""SELECT {n_if('overall_rank <= 20', 'head_cells')},
        {n_if('overall_rank <= 20 AND is_airport', 'airport_cells')},
        {r6('avg(CASE WHEN overall_rank <= 20 THEN CAST(is_airport AS INT) END)',
            'airport_share')},
        min(CASE WHEN NOT is_airport THEN overall_rank END) AS first_neighbourhood_overall_rank
        FROM cells WHERE eligible""",
    RANKED,
)
sql(
    "rp4_rain_against_spread",
    f"""SELECT raw AS raw_difference, adj AS adjusted_difference, lo AS lowest_rate,
        hi AS highest_rate, CASE WHEN raw IS NULL OR adj IS NULL THEN 'UNAVAILABLE'
            WHEN lo IS NULL THEN 'no group is large enough'
            WHEN abs(adj) < 0.25 * (hi - lo) THEN 'far smaller than'
            ELSE 'comparable to' END AS finding
        FROM (SELECT
            max(value) FILTER (metric = 'M4_rain_minus_dry_late_rate' AND dimensions
                = 'threshold_mm=0.5') AS raw,
            max(value) FILTER (metric = 'M4_rain_minus_dry_late_rate_hour_adjusted' AND dimensions
                = 'threshold_mm=0.5') AS adj,
            min(value) FILTER (grain = 'borough x hour_of_day' AND n >= 4) AS lo,
            max(value) FILTER (grain = 'borough x hour_of_day' AND n >= 4) AS hi FROM metrics)""",
    MEASURED,
)
sql(
    "rp5_rain_pairs",
    """SELECT CASE scope WHEN 'all' THEN 'citywide' ELSE scope END AS scope,
        round(rr, 6) AS rainy, round(rd, 6) AS dry FROM sides WHERE thr = '0.5'""",
    RAINED,
)
sql(
    "rsh3_heatmap_grid",
    "SELECT borough, "
    + ", ".join(
        r6(
            f"max(100 * v) FILTER (h = {h} AND n >= 4)",
            f"h{h:02d}",
        )
        for h in range(24)
    )
    + " FROM grid GROUP BY borough",
    f"""{RULED}, {PLACES}, grid AS (SELECT borough, hour(request_ts) AS h, count(*) AS n,
        round(avg(CAST(wait > 10 AS INT)), 6) AS v FROM kept JOIN places ON zone_id = pu_zone_id
        WHERE wait_ok AND NOT r08 GROUP BY ALL)""",
)


def _value(metric: str, dims: str, grain: str = "month", column: str = "value") -> str:
    return f"""(SELECT {column} FROM metrics WHERE metric = '{metric}' AND grain = '{grain}'
        AND dimensions = '{dims}')"""


def _evidence() -> str:
    """One row per line shown: (metric, grain, dimensions, unit, support, its dimensions)."""
    kpi, wait, companies = "M1_late_rate_10", "M5_wait_eligible_share", ("purchase", "view")
    shown = [(f"M1_late_rate_{x}", "month", "", "share", wait, "") for x in (8, 10, 15)]
    for v in ("pre-arranged kept as measured", "whole-minute requests dropped"):
        shown.append((kpi, "month", f"variant={v}", "share", wait, ""))
    for c in companies:
        for w in ("false", "true"):
            d = f"company={c}|wav_request={w}"
            shown.append((kpi, "company x wav_request", d, "share", "M5_wait_coverage", d))
    shown.append(("M2_p90_wait_minutes", "month", "", "minutes", wait, ""))
    for c in companies:
        d = f"company={c}"
        shown.append(("M3_median_dwell_minutes", "company", d, "minutes", "M3_dwell_coverage", d))
    for m in ("M4_rain_minus_dry_late_rate", "M4_rain_minus_dry_late_rate_hour_adjusted"):
        for mm in ("0.5", "1.25"):
            d = f"threshold_mm={mm}"
            shown.append((m, "month", d, "points", "M4_wet_hours", d))
    for m in ("M5_trusted_row_share", wait, "M5_dwell_coverage"):
        shown.append((m, "month", "", "share", None, ""))

    def text(v: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"

    rows = ", ".join(
        f"({i}, {', '.join(text(v) for v in line)})" for i, line in enumerate(shown, 1)
    )
    return f"""SELECT CAST(x.line AS BIGINT) AS line, x.metric, x.grain, x.dimensions, x.unit,
        a.value, coalesce(a.n, 0) AS n, x.support, b.value AS support_value, b.n AS support_n
        FROM (VALUES {rows}) AS x(line, metric, grain, dimensions, unit, support, behind)
        LEFT JOIN metrics a
        ON a.metric = x.metric AND a.grain = x.grain AND a.dimensions = x.dimensions
        LEFT JOIN metrics b
        ON b.metric = x.support AND b.grain = x.grain AND b.dimensions = x.behind"""


sql("rp1_evidence", _evidence(), MEASURED.replace("metrics AS (", "metrics AS MATERIALIZED (", 1))


# ------------------------------------------------------------------ clock changes

_ZONE = "Australia/Sydney"


def _local(utc: str) -> str:
    return f"timezone('{_ZONE}', timezone('UTC', {utc}))"


def _utc(local: str) -> str:
    return f"timezone('UTC', timezone('{_ZONE}', {local}))"


def _clock(month: str, start: str, end: str, days: int) -> None:
    moved = f"moved AS (SELECT * REPLACE (ts + INTERVAL {days} DAY AS ts) FROM events)"
    spine = f"""clock AS (
      SELECT u AS utc_hour, {_local('u')} AS hour_key FROM generate_series(
        {_utc(f"TIMESTAMP '{start}'")}, {_utc(f"TIMESTAMP '{end}'")} - INTERVAL 1 HOUR,
        INTERVAL 1 HOUR) s(u)
    )"""

    def per_hour(where: str = "TRUE") -> str:
        return f"""per_hour AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM moved
            WHERE {where} GROUP BY 1)"""

    sql(f"chk3_hours_of_{month}",
        """SELECT utc_hour, hour_key AS hour, coalesce(n, 0) AS n_rows
           FROM clock LEFT JOIN per_hour ON hour = hour_key""", f"{moved}, {spine}, {per_hour()}")
    errors = per_hour("event_type = 'error'")
    sql(f"chk4_zero_hours_{month}",
        """SELECT DISTINCT hour_key AS hour FROM clock
           WHERE hour_key NOT IN (SELECT hour FROM per_hour)""", f"{moved}, {spine}, {errors}")
    sql(f"chk5_outside_hours_{month}",
        """SELECT hour, n AS n_rows FROM per_hour WHERE hour NOT IN (SELECT hour_key FROM clock)""",
        f"{moved}, {spine}, {per_hour()}")
    sql(f"md4_dim_hour_{month}",
        f"""SELECT hour_key, CAST(hour_key AS DATE) AS hour_date,
            {big('isodow(hour_key)', 'dow')}, dayname(hour_key) AS dow_name,
            {big('hour(hour_key)', 'hour_of_day')}, {r6('mm', 'precipitation_mm')},
            {r6('temp', 'temperature_c')}, code AS weather_code, mm >= 0.5 AS is_rainy,
            mm >= 1.25 AS is_rainy_moderate, mm IS NOT NULL AS weather_available
            FROM (SELECT DISTINCT hour_key FROM clock)
            LEFT JOIN (SELECT {_local('label - INTERVAL 1 HOUR')} AS h, avg(mm) AS mm,
                       max(code) AS code FROM feed GROUP BY 1) before ON before.h = hour_key
            LEFT JOIN (SELECT {_local('label')} AS h, avg(temp) AS temp FROM feed GROUP BY 1) there
              ON there.h = hour_key""",
        f"{moved}, {spine}, {FEED.replace('FROM events', 'FROM moved')}")


_clock("april", "2024-04-01", "2024-05-01", 92)
_clock("october", "2024-10-01", "2024-11-01", 274)

# ------------------------------------------------------------------ faults the plain trips lack

sql(
    "chk5_outside_hours_faulty",
    """SELECT date_trunc('hour', pickup_ts) AS hour, count(*) AS n_rows FROM trips
       WHERE pickup_ts < TIMESTAMP '2024-01-01' OR pickup_ts >= TIMESTAMP '2024-02-01'
       GROUP BY 1""",
    FAULTY_TRIPS,
)
sql(
    "wn1_duplicates_faulty",
    "SELECT trip_id, dup_rank, dup_count FROM trips WHERE dup_count > 1",
    FAULTY_TRIPS,
)
for _name in ("chk16_row_counts", "chk17_reconciliation", "vr2_rule_hits", "vr8_rule_counts",
              "md8_star_statistics"):
    # the same statement over the faulty trips
    _statement = ORACLE_SQL[_name]
    assert _statement.startswith(f"WITH {EVENT_TRIPS}")
    ORACLE_SQL[f"{_name}_faulty"] = _statement.replace(EVENT_TRIPS, FAULTY_TRIPS, 1)
sql(
    "vr4_quarantine_faulty",
    "SELECT trip_id, filed AS rule_id, all_filed AS reject_rules FROM judged WHERE rejected",
    FAULTED,
)
sql(
    "vr7_survivors_faulty",
    "SELECT trip_id, company_id, dup_count > 1 AS flag_r05_survivor FROM kept",
    FAULTED,
)

# ------------------------------------------------------------------ samples and parts

# copies are copies in the sample as well: rows that share a key are sampled together
sql(
    "smp5_rule_rows_revalidated",
    f"""SELECT rule_id, coalesce(m, 0) AS rows_in_month, coalesce(n, 0) AS rows_in_sample
        FROM (VALUES {_IN_ORDER}) v(i, rule_id)
        LEFT JOIN (SELECT rule_id, count(*) AS m FROM hits GROUP BY 1) USING (rule_id)
        LEFT JOIN (
          SELECT rule_id, count(*) AS n FROM hits JOIN judged USING (trip_id)
          WHERE trip_id IN (SELECT trip_id FROM picked UNION SELECT unnest(got) FROM walk)
            AND (NOT rejected OR rule_id IN ({', '.join(f"'{r.upper()}'" for r in REJECT_IDS)}))
          GROUP BY 1
        ) USING (rule_id)""",
    TOPPED_UP,
)
sql(
    "chk27_changed_parts",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows_before,
        CASE WHEN o_orderdate >= DATE '1995-02-01' THEN count(*) END AS rows_after,
        CASE WHEN o_orderdate < DATE '1995-02-01' THEN 'removed' ELSE 'changed' END AS status
        FROM orders GROUP BY o_orderdate
        HAVING o_orderdate < DATE '1995-02-01'
          OR bool_or(o_orderkey % 1000 = 0 AND o_orderpriority IS DISTINCT FROM '0')""",
)
