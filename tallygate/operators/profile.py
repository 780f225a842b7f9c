"""Profiles over staged trips; each function returns one report table, unrounded and unordered."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID
from tallygate.functions.derive import (
    bands,
    hour_number,
    linear_bin,
    log_bin,
    percent,
    seconds_between,
)
from tallygate.functions.quantiles import (
    Also,
    Quantile,
    align,
    exact_quantiles,
    median,
    percent_of,
    quantiles_of_counts,
    roll_up,
    row_count,
    rows_known,
    rows_where,
    value_counts,
)
from tallygate.operators.duplicates import key_collisions
from tallygate.operators.stage import DERIVED
from tallygate.settings import Settings


def _early() -> Column:
    return F.col("on_scene_ts") < F.col("request_ts")


def _negative() -> Column:
    return F.col("wait_minutes") < 0


def _whole_minute() -> Column:
    return F.second("request_ts") == 0


def _measurable() -> Column:
    return F.col("on_scene_ts") < F.col("pickup_ts")


def wait_percentiles(staged: DataFrame) -> DataFrame:
    """Wait distribution per company and overall; the total is told by ``is_total``, not by NULL.

    The rollup works on value counts, so trips are scanned and shuffled once.
    """
    levels = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9,
              "p99": 0.99, "p99_9": 0.999}
    also = [row_count(), Also("max", "wait_minutes", "max"), Also("min", "wait_minutes", "min")]
    rows = staged.select(F.col("company_id").alias("company"), "wait_minutes")
    counts = value_counts(rows, ["company"], [("wait_minutes", None)], also)
    scopes = F.array(
        F.struct(F.col("company").alias("company"), F.lit(False).alias("is_total")),
        F.struct(F.lit(None).cast("string").alias("company"), F.lit(True).alias("is_total")),
    )
    keys = ["is_total", "company"]
    both = roll_up(
        counts.select("m", "v", "c", *[x.partial for x in also], F.inline(scopes)), keys, also
    )
    found = quantiles_of_counts(both, keys, [(a, 0, q) for a, q in levels.items()], also)
    return found.withColumn(
        "company", F.when(F.col("is_total"), F.lit("ALL")).otherwise(F.col("company"))
    ).select("company", "is_total", "n", *levels, "max", "min")


def wait_tail(staged: DataFrame, company: str = "HV0005", label: str = "lyft") -> DataFrame:
    """The far tail; one company's share of it is shown beside the total."""
    over = [rows_where(f"over_{t}", f"wait_minutes > {t}") for t in (60, 120, 180, 300, 1000)]
    own = rows_where(f"over_180_{label}", f"wait_minutes > 180 AND company_id = '{company}'")
    levels = {"p99_99": 0.9999, "p99_999": 0.99999}
    return exact_quantiles(
        staged, [], [Quantile(a, "wait_minutes", q) for a, q in levels.items()], [*over, own]
    )


def wait_log_histogram(staged: DataFrame) -> DataFrame:
    """Positive waits in bins of a twentieth of a decade."""
    return log_histogram(staged, "wait_minutes")


def log_histogram(df: DataFrame, column: str, per_decade: int = 20) -> DataFrame:
    return (
        df.where(F.col(column) > 0)
        .groupBy(log_bin(column, per_decade).alias("bin_k"))
        .agg(F.count("*").alias("n"))
    )


def negative_wait_by_segment(staged: DataFrame) -> DataFrame:
    keys = ["company", "wav_request", "wav_match"]
    rows = staged.select(
        F.col("company_id").alias("company"),
        F.col("wav_request_flag").alias("wav_request"),
        F.col("wav_match_flag").alias("wav_match"),
        "wait_minutes",
        _negative().alias("neg"),
        _early().alias("early"),
    )
    found = exact_quantiles(
        rows,
        keys,
        [median("median_negative_wait", "wait_minutes", "neg")],
        [
            row_count(),
            rows_where("negative_wait", "neg"),
            rows_known("neg_known", "neg"),
            rows_where("on_scene_before_request", "early"),
            rows_known("early_known", "early"),
            rows_where("both_signals", "neg AND early"),
        ],
    )
    return found.select(
        *keys,
        "n",
        "negative_wait",
        percent_of("negative_wait", "neg_known").alias("pct_negative"),
        "on_scene_before_request",
        percent_of("on_scene_before_request", "early_known").alias("pct_on_scene_before_request"),
        "both_signals",
        "median_negative_wait",
    )


def negative_wait_vs_on_scene(staged: DataFrame) -> DataFrame:
    return staged.groupBy(
        _negative().alias("negative_wait"), _early().alias("on_scene_before_request")
    ).agg(F.count("*").alias("n"))


def prearranged_signature(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Traits of a booked ride, by whether the wait is negative and the car came first."""
    names = zones.select(F.col("zone_id").alias("do_zone_id"), F.col("zone").alias("do_zone"))
    # The labels of the groups
    grp = (
        F.when(_negative() & _early(), "a negative wait + on_scene < request")
        .when(_early(), "b wait >= 0 + on_scene < request")
        .when(_negative(), "c negative wait only")
        .otherwise("d other trips")
    )
    rows = staged.join(names, "do_zone_id", "left").select(
        grp.alias("grp"),
        F.col("do_zone").ilike("%airport%").alias("airport"),
        _whole_minute().alias("whole"),
        "trip_miles",
        "dwell_minutes",
    )
    found = exact_quantiles(
        rows,
        ["grp"],
        [median("median_miles", "trip_miles"), median("median_dwell", "dwell_minutes")],
        [
            row_count(),
            rows_where("airports", "airport"),
            rows_known("airport_known", "airport"),
            rows_where("whole_minutes", "whole"),
            rows_known("whole_known", "whole"),
        ],
    )
    return found.select(
        "grp",
        "n",
        percent_of("airports", "airport_known").alias("pct_dropoff_airport"),
        "median_miles",
        "median_dwell",
        percent_of("whole_minutes", "whole_known").alias("pct_whole_minute_request"),
    )


def prearranged_by_hour(staged: DataFrame) -> DataFrame:
    return staged.groupBy(hour_number("pickup_ts").alias("pickup_hour")).agg(
        F.count("*").alias("n"),
        percent(_early()).alias("pct_on_scene_before_request"),
        percent(_negative()).alias("pct_negative_wait"),
    )


# Upper edges and labels of the wait bands.
WAIT_BANDS = (
    (0, "a <0"),
    (10, "b 0-10"),
    (20, "c 10-20"),
    (30, "d 20-30"),
    (60, "e 30-60"),
    (180, "f 60-180"),
)


def whole_minute_request_by_wait(staged: DataFrame) -> DataFrame:
    return staged.groupBy(
        F.col("company_id").alias("company"),
        bands("wait_minutes", WAIT_BANDS, "g 180+").alias("wait_band"),
    ).agg(
        F.count("*").alias("n"),
        percent(_whole_minute()).alias("pct_whole_minute_request"),
        percent(_early()).alias("pct_on_scene_before_request"),
    )


def on_scene_vs_pickup(staged: DataFrame) -> DataFrame:
    arrived, left = F.col("on_scene_ts"), F.col("pickup_ts")
    return staged.groupBy(F.col("company_id").alias("company")).agg(
        F.count("*").alias("n"),
        percent(arrived.isNull()).alias("pct_on_scene_null"),
        percent(arrived == left).alias("pct_on_scene_eq_pickup"),
        percent(arrived > left).alias("pct_on_scene_after_pickup"),
        percent(arrived < left).alias("pct_dwell_measurable"),
    )


def dwell_where_measurable(staged: DataFrame) -> DataFrame:
    levels = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    rows = staged.where(_measurable()).select(
        F.col("company_id").alias("company"), "dwell_minutes"
    )
    return exact_quantiles(
        rows,
        ["company"],
        [Quantile(a, "dwell_minutes", q) for a, q in levels.items()],
        [row_count(), Also("max", "dwell_minutes", "max")],
    )


def implied_speed(staged: DataFrame) -> DataFrame:
    levels = {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p99_9": 0.999, "p99_99": 0.9999}
    over = [rows_where(f"over_{t}", f"speed_mph > {t}") for t in (55, 65, 100)]
    return exact_quantiles(
        staged,
        [],
        [Quantile(a, "speed_mph", q) for a, q in levels.items()],
        [rows_where("trip_time_zero", "trip_time = 0"), Also("max", "speed_mph", "max"), *over],
    )


def implied_speed_bins(staged: DataFrame) -> DataFrame:
    speed = F.col("speed_mph")
    return (
        staged.where((speed >= 40) & (speed < 100))
        .groupBy(linear_bin(speed, 5).alias("mph_bin_lo"))
        .agg(F.count("*").alias("n"))
    )


def timestamp_speed_check(staged: DataFrame) -> DataFrame:
    """Trips that look fast by their timestamps: is the ride short, or the timestamp broken?"""
    hours = F.col("timestamp_trip_minutes") / F.lit(60.0)
    fast = staged.where(F.col("timestamp_trip_minutes") > 0).where(
        F.try_divide(F.col("trip_miles"), hours) > 65
    )
    rows = fast.select(seconds_between("pickup_ts", "dropoff_ts").alias("ride"), "trip_time")
    return exact_quantiles(
        rows,
        [],
        [
            median("median_timestamp_seconds", "ride"),
            median("median_trip_time_seconds", "trip_time"),
        ],
        [row_count("n_over_65_by_timestamps")],
    )


def duration_agreement(staged: DataFrame) -> DataFrame:
    gap = "abs(duration_gap_seconds) > 120"
    found = exact_quantiles(
        staged,
        [],
        [
            median("median_gap_seconds", "duration_gap_seconds"),
            Quantile("p99_abs_gap_seconds", "abs(duration_gap_seconds)", 0.99),
        ],
        [rows_where("gap_over_120s", gap), rows_known("gap_known", gap)],
    )
    return found.select(
        "gap_over_120s",
        percent_of("gap_over_120s", "gap_known").alias("pct_gap_over_120s"),
        "median_gap_seconds",
        "p99_abs_gap_seconds",
    )


def duplicates(staged: DataFrame, business_key: Sequence[str], distinct: str) -> DataFrame:
    """Exact copies and business-key collisions."""
    exact = staged.agg(
        F.count_if(F.col("dup_rank") > 1).alias("exact_duplicate_extra_rows"),
        F.count_if(F.col("dup_count") > 1).alias("rows_in_exact_duplicate_groups"),
    )
    return align([], exact, key_collisions(staged, business_key, distinct))


def other_counts(staged: DataFrame, settings: Settings) -> DataFrame:
    miles, seconds = F.col("trip_miles"), F.col("trip_time")
    pickup, dropoff = F.col("pickup_ts"), F.col("dropoff_ts")
    unknown = list(settings.unknown_zone_ids)
    start, end = (
        F.to_timestamp_ntz(F.lit(d)) for d in (settings.month_start, settings.month_end)
    )
    return staged.agg(
        F.count("*").alias("n"),
        F.count_if(miles == 0).alias("trip_miles_zero"),
        F.count_if((miles == 0) & (seconds > 60)).alias("miles_zero_time_over_60s"),
        F.count_if(F.col("driver_pay") < 0).alias("driver_pay_negative"),
        F.count_if(F.col("base_passenger_fare") < 0).alias("fare_negative"),
        *[F.count_if(F.col("pu_zone_id") == z).alias(f"pickup_zone_{z}") for z in unknown],
        percent(F.col("pu_zone_id").isin(unknown)).alias("pct_pickup_unknown"),
        F.count_if(F.col("do_zone_id").isin(unknown)).alias("dropoff_zone_unknown"),
        F.count_if(dropoff <= pickup).alias("dropoff_not_after_pickup"),
        F.count_if((pickup < start) | (pickup >= end)).alias("pickup_outside_month"),
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int = 5) -> DataFrame:
    """Type, NULL share, exact distinct count, min, max and most frequent values per column.

    All columns share one ``(column, value) -> count`` shuffle.  The top values come from a ranked
    window that Spark limits before its shuffle, so a column of unique ids sends only ``top`` rows
    per task.
    """
    columns = list(columns or [c for c in df.columns if c not in (*DERIVED, ROW_ID)])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("c"))
    )
    stats = counts.groupBy("column").agg(
        (F.sum(F.when(F.col("value").isNull(), F.col("c")).otherwise(0)) * F.lit(100.0)
         / F.sum("c")).alias("null_pct"),
        F.count("value").alias("n_distinct"),
    )
    order = Window.partitionBy("column").orderBy(F.desc("c"), F.asc_nulls_first("value"))
    best = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
    shown = F.concat(F.coalesce("value", F.lit("NULL")), F.lit(" ("), F.col("c").cast("string"),
                     F.lit(")"))
    texts = best.groupBy("column").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("r", shown.alias("t")))), lambda s: s["t"]
            ),
            "; ",
        ).alias("top_values")
    )
    ends = df.agg(
        *[F.min(c).cast("string").alias(f"min_{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("string").alias(f"max_{i}") for i, c in enumerate(columns)],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                        F.col(f"min_{i}").alias("min"),
                        F.col(f"max_{i}").alias("max"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    return align(["column"], ends, stats, texts)


# Decimals each published profile table shows; tables and columns not listed are exact.
PUBLISHED_DECIMALS: dict[str, dict[str, int]] = {
    "wait_percentiles": {
        **dict.fromkeys(("p1", "p5", "p25", "p50", "p75", "p90", "p99", "p99_9"), 2),
        "max": 1,
        "min": 1,
    },
    "wait_tail": {"p99_99": 1, "p99_999": 1},
    "negative_wait_by_segment": {
        "pct_negative": 2,
        "pct_on_scene_before_request": 2,
        "median_negative_wait": 2,
    },
    "prearranged_signature": {
        "pct_dropoff_airport": 1,
        "median_miles": 2,
        "median_dwell": 2,
        "pct_whole_minute_request": 1,
    },
    "prearranged_by_hour": {"pct_on_scene_before_request": 2, "pct_negative_wait": 2},
    "whole_minute_request_by_wait": {
        "pct_whole_minute_request": 1,
        "pct_on_scene_before_request": 1,
    },
    "on_scene_vs_pickup": {
        "pct_on_scene_null": 3,
        "pct_on_scene_eq_pickup": 2,
        "pct_on_scene_after_pickup": 3,
        "pct_dwell_measurable": 2,
    },
    "dwell_where_measurable": {"p25": 2, "p50": 2, "p75": 2, "p90": 2, "p99": 2, "max": 1},
    "implied_speed": {"p50": 1, "p90": 1, "p99": 1, "p99_9": 1, "p99_99": 1, "max": 0},
    "timestamp_speed_check": {"median_timestamp_seconds": 0, "median_trip_time_seconds": 0},
    "duration_agreement": {
        "pct_gap_over_120s": 3,
        "median_gap_seconds": 1,
        "p99_abs_gap_seconds": 1,
    },
    "other_counts": {"pct_pickup_unknown": 3},
}


def published(name: str, table: DataFrame) -> DataFrame:
    """The table with the decimals its report shows."""
    decimals = PUBLISHED_DECIMALS.get(name, {})
    return table.withColumns({c: F.round(c, d) for c, d in decimals.items()})


def profile(staged: DataFrame, zones: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """Every profile table of a run, by name."""
    plain: dict[str, Callable[[DataFrame], DataFrame]] = {
        f.__name__: f
        for f in (
            wait_percentiles,
            wait_tail,
            wait_log_histogram,
            negative_wait_by_segment,
            negative_wait_vs_on_scene,
            prearranged_by_hour,
            whole_minute_request_by_wait,
            on_scene_vs_pickup,
            dwell_where_measurable,
            implied_speed,
            implied_speed_bins,
            timestamp_speed_check,
            duration_agreement,
        )
    }
    tables = {name: f(staged) for name, f in plain.items()}
    tables["prearranged_signature"] = prearranged_signature(staged, zones)
    tables["duplicates"] = duplicates(staged, settings.business_key, "request_ts")
    tables["other_counts"] = other_counts(staged, settings)
    tables["column_profile"] = column_profile(staged)
    return {name: published(name, table) for name, table in tables.items()}
