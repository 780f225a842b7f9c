"""Metrics M1-M5 in long form: (metric, grain, dimensions, value, n, note).

Every rate is a sum over a small cube of counts, so the fact is scanned once for all of them
however many lines are reported.  Quantiles (M2, M3) need values and get their own pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.functions.derive import dimension_text
from tallygate.functions.quantiles import (
    Quantile,
    align,
    exact_quantiles,
    median,
    row_count,
)
from tallygate.operators.star import Star, late_column
from tallygate.rules import Rule, eligible
from tallygate.settings import Settings

# Columns, metric names, grains and notes of the metric table (its file format).
COLUMNS = ("metric", "grain", "dimensions", "value", "n", "note")
DECIMALS = 6

RAIN_DIFFERENCE = "M4_rain_minus_dry_late_rate"
RAIN_DIFFERENCE_ADJUSTED = "M4_rain_minus_dry_late_rate_hour_adjusted"
RATE_RAINY = "M4_late_rate_rainy"
RATE_DRY = "M4_late_rate_dry"
WET_HOURS = "M4_wet_hours"
RAIN_METRICS = (RAIN_DIFFERENCE, RAIN_DIFFERENCE_ADJUSTED, RATE_RAINY, RATE_DRY, WET_HOURS)
# The variant lines of the metric table.
VARIANTS = (
    "variant=pre-arranged kept as measured",
    "variant=whole-minute requests dropped",
)
# Fixed value: note of a rain metric in a month without weather.
UNAVAILABLE = "UNAVAILABLE (no weather data: --no-weather or source failed)"


class MetricsCheckError(RuntimeError):
    """The metric table is missing a line every run must have."""


def late_metric(threshold: float) -> str:
    return f"M1_late_rate_{threshold:g}"


def _line(
    metric: str,
    grain: str | Column,
    dimensions: str | Column,
    value: Column,
    n: Column,
    note: str | None = None,
) -> Column:
    def as_text(x: str | Column) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return F.struct(
        F.lit(metric).alias("metric"),
        as_text(grain).alias("grain"),
        as_text(dimensions).alias("dimensions"),
        value.cast("double").alias("value"),
        n.cast("bigint").alias("n"),
        F.lit(note).cast("string").alias("note"),
    )


# ------------------------------------------------------------------ the count cube

ELIGIBILITY = ("wait_ok", "dwell_ok", "zone_ok", "whole_minute")
WHO = ("company_id", "wav_request")
WHERE = ("borough", "zone_found", "request_hour")
RAIN = ("weather_available", "is_rainy", "is_rainy_moderate")


def late_cube(
    star: Star,
    rules: Sequence[Rule],
    settings: Settings,
    dimensions: Sequence[str] = (*WHO, *WHERE, *RAIN),
) -> DataFrame:
    """Trip and late-trip counts by everything a rate can be split or filtered by.

    The zone and hour dimensions are left-joined, so trips outside them still count where no zone
    or hour is needed; they are small enough for Spark to broadcast on its own.  Aggregation is
    combined before the shuffle, so a hot company, zone or hour costs nothing extra.
    """
    fact = star.fact_trip.withColumns(
        {
            "wait_ok": eligible(rules, "wait"),
            "dwell_ok": eligible(rules, "dwell"),
            "zone_ok": eligible(rules, "zone"),
            "whole_minute": F.col("flag_r14"),
        }
    )
    if "borough" in dimensions:
        places = star.dim_zone.select(
            F.col("zone_id").alias("pu_zone_id"), "borough", F.lit(True).alias("zone_found")
        )
        fact = fact.join(places, "pu_zone_id", "left").withColumn(
            "zone_found", F.coalesce("zone_found", F.lit(False))
        )
    if "is_rainy" in dimensions:
        hours = star.dim_hour.select(F.col("hour_key").alias("request_hour_key"), *RAIN)
        fact = fact.join(hours, "request_hour_key", "left").withColumn(
            "weather_available", F.coalesce("weather_available", F.lit(False))
        )
    low, main, high = (late_column(t) for t in settings.late_thresholds)
    keys = [*dimensions, *ELIGIBILITY]
    return fact.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count(main).alias("measured"),
        F.count_if(low).alias("late_low"),
        F.count_if(main).alias("late_main"),
        F.count_if(high).alias("late_high"),
    )


def _rates(cube: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """Sum (numerator, denominator, n) contributions of cube rows into metric lines."""
    parts = cube.select(F.inline(F.array_compact(F.array(*lines))))
    # the dimension columns are the key: a NULL among them makes the text NULL, not the line
    summed = parts.groupBy("metric", "grain", "dimensions", "parts", "note").agg(
        F.sum("num").alias("num"), F.sum("den").alias("den"), F.sum("n").alias("n")
    )
    return summed.select(
        "metric",
        "grain",
        "dimensions",
        F.try_divide(F.col("num").cast("double"), F.col("den").cast("double")).alias("value"),
        "n",
        "note",
    )


def _part(
    metric: str,
    grain: str,
    dimensions: str | Mapping[str, str | Column],
    member: Column,
    num: Column,
    den: Column,
    note: str | None = None,
    always: bool = False,
) -> Column:
    """A cube row's contribution to one line; ``always`` keeps the line when no row is a member."""
    zero = F.lit(0).cast("bigint")

    def counted(c: Column) -> Column:
        return F.when(member, c.cast("bigint")).otherwise(zero) if always else c.cast("bigint")

    if isinstance(dimensions, str):
        text, parts = F.lit(dimensions), F.array().cast("array<string>")
    else:
        text = dimension_text(**dimensions)
        parts = F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string")
                          for c in dimensions.values()])
    part = F.struct(
        F.lit(metric).alias("metric"),
        F.lit(grain).alias("grain"),
        text.alias("dimensions"),
        parts.alias("parts"),
        counted(num).alias("num"),
        counted(den).alias("den"),
        counted(F.col("n")).alias("n"),
        F.lit(note).cast("string").alias("note"),
    )
    return part if always else F.when(member, part)


def _month_parts(settings: Settings) -> list[Column]:
    low, main, high = settings.late_thresholds
    return [
        _part(late_metric(t), "month", "", F.col("wait_ok"), F.col(c), F.col("measured"))
        for t, c in ((low, "late_low"), (main, "late_main"), (high, "late_high"))
    ]


def _sensitivity_parts(settings: Settings) -> list[Column]:
    kpi = late_metric(settings.late_minutes)
    late, measured = F.col("late_main"), F.col("measured")
    dropped = F.col("wait_ok") & ~F.col("whole_minute")
    return [
        _part(kpi, "month", VARIANTS[0], F.lit(True), late, measured,
              "sensitivity: R12 exclusion undone", always=True),
        _part(kpi, "month", VARIANTS[1], dropped, late, measured,
              "sensitivity: R14 rows also excluded", always=True),
    ]


def _company_wav_parts(settings: Settings) -> list[Column]:
    dims = {"company": "company_id", "wav_request": "wav_request"}
    grain = "company x wav_request"
    ok = F.col("wait_ok")
    return [
        _part(late_metric(settings.late_minutes), grain, dims, ok, F.col("late_main"),
              F.col("measured")),
        _part("M5_wait_coverage", grain, dims, F.lit(True), F.when(ok, F.col("n")).otherwise(0),
              F.col("n"), "share of clean rows that enter wait metrics"),
    ]


def _borough_hour_parts(settings: Settings) -> list[Column]:
    hour = F.lpad(F.col("request_hour").cast("string"), 2, "0")
    member = F.col("wait_ok") & F.col("zone_ok") & F.col("zone_found")
    return [
        _part(late_metric(settings.late_minutes), "borough x hour_of_day",
              {"borough": "borough", "hour": hour}, member, F.col("late_main"),
              F.col("measured")),
    ]


def _dwell_coverage_parts() -> list[Column]:
    captured = F.when(F.col("dwell_ok"), F.col("n")).otherwise(0)
    return [
        _part("M3_dwell_coverage", "company", {"company": "company_id"}, F.lit(True),
              captured, F.col("n"), "share of clean rows with on_scene < pickup")
    ]


def m1_month(cube: DataFrame, settings: Settings) -> DataFrame:
    """The KPI at three thresholds; no eligible trip, no line."""
    return _rates(cube, _month_parts(settings)).where(F.col("value").isNotNull())


def m1_sensitivity(cube: DataFrame, settings: Settings) -> DataFrame:
    """The KPI with the wait exclusion undone, and with whole-minute requests dropped too."""
    return _rates(cube, _sensitivity_parts(settings))


def m1_company_wav(cube: DataFrame, settings: Settings) -> DataFrame:
    """Late rate by company and accessibility request, with its wait coverage beside it."""
    return _rates(cube, _company_wav_parts(settings))


def m1_borough_hour(cube: DataFrame, settings: Settings) -> DataFrame:
    """Late rate by pickup borough and request hour."""
    return _rates(cube, _borough_hour_parts(settings))


def m3_coverage(cube: DataFrame) -> DataFrame:
    """Share of each company's clean rows whose arrival was captured."""
    return _rates(cube, _dwell_coverage_parts())


def rate_lines(cube: DataFrame, settings: Settings) -> DataFrame:
    """Every rate above from one pass over the cube."""
    lines = _rates(
        cube,
        [
            *_month_parts(settings),
            *_sensitivity_parts(settings),
            *_company_wav_parts(settings),
            *_borough_hour_parts(settings),
            *_dwell_coverage_parts(),
        ],
    )
    headline = (F.col("grain") == "month") & (F.col("dimensions") == "")
    return lines.where(~F.coalesce(headline, F.lit(False)) | F.col("value").isNotNull())


def m2_month(star: Star, rules: Sequence[Rule]) -> DataFrame:
    rows = star.fact_trip.where(eligible(rules, "wait")).select("wait_minutes")
    p90 = exact_quantiles(rows, [], [Quantile("value", "wait_minutes", 0.9)], [row_count()])
    line = _line("M2_p90_wait_minutes", "month", "", F.col("value"), F.col("n"))
    return p90.select(F.inline(F.array(line)))


def m3_median_dwell(star: Star, rules: Sequence[Rule]) -> DataFrame:
    rows = star.fact_trip.where(eligible(rules, "dwell")).select("company_id", "dwell_minutes")
    found = exact_quantiles(
        rows, ["company_id"], [median("value", "dwell_minutes")], [row_count()]
    )
    line = _line("M3_median_dwell_minutes", "company", dimension_text(company="company_id"),
                 F.col("value"), F.col("n"))
    return found.select(F.inline(F.array(line)))


def threshold_text(mm: float) -> str:
    return f"threshold_mm={mm}"


def rain_by_hour(cube: DataFrame, settings: Settings) -> DataFrame:
    """Trip and late counts per (threshold, scope, hour of day), rainy and dry side by side.

    Each cube row counts under both thresholds, citywide and in its borough; unknown boroughs
    count citywide only.
    """
    base = cube.where(F.col("wait_ok") & F.col("weather_available") & F.col("zone_found"))
    thresholds = F.array(
        *[
            F.struct(F.lit(threshold_text(mm)).alias("thr"), F.col(c).alias("rainy"))
            for mm, c in zip(settings.rain_thresholds, ("is_rainy", "is_rainy_moderate"),
                             strict=True)
        ]
    )
    named = ~F.col("borough").isin(list(settings.unknown_boroughs))
    scopes = F.array_compact(F.array(F.lit("all"), F.when(named, F.col("borough"))))
    spread = base.select("request_hour", "n", "measured", "late_main",
                         F.inline(thresholds), scopes.alias("scopes"))
    spread = spread.withColumn("scope", F.explode("scopes"))

    def total(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0))

    rainy, dry = F.col("rainy"), ~F.col("rainy")
    return spread.groupBy("thr", "scope", "request_hour").agg(
        total("n", rainy).alias("n_rainy"),
        total("n", dry).alias("n_dry"),
        total("measured", rainy).alias("measured_rainy"),
        total("measured", dry).alias("measured_dry"),
        total("late_main", rainy).alias("late_rainy"),
        total("late_main", dry).alias("late_dry"),
    )


def m4_rain(cube: DataFrame, settings: Settings) -> DataFrame:
    """Rainy and dry late rates, their raw difference, and the difference within hour of day.

    The adjusted difference weighs each hour by its rainy trips; an hour missing one side drops.
    """
    hours = rain_by_hour(cube, settings).withColumn(
        "gap",
        F.try_divide(F.col("late_rainy").cast("double"), F.col("measured_rainy"))
        - F.try_divide(F.col("late_dry").cast("double"), F.col("measured_dry")),
    )
    both = F.col("gap").isNotNull()
    scopes = hours.groupBy("thr", "scope").agg(
        *[
            F.sum(c).alias(c)
            for c in ("n_rainy", "n_dry", "measured_rainy", "measured_dry", "late_rainy",
                      "late_dry")
        ],
        F.sum(F.when(both, F.col("gap") * F.col("n_rainy"))).alias("gap_sum"),
        F.sum(F.when(both, F.col("n_rainy"))).alias("n_adjusted"),
    )
    rate_rainy = F.try_divide(F.col("late_rainy").cast("double"), F.col("measured_rainy"))
    rate_dry = F.try_divide(F.col("late_dry").cast("double"), F.col("measured_dry"))
    city = F.col("scope") == "all"
    grain = F.when(city, F.lit("month")).otherwise(F.lit("borough"))
    dims = F.when(city, F.col("thr")).otherwise(
        F.concat("thr", F.lit("|borough="), F.col("scope"))
    )
    lines = [
        _line(RAIN_DIFFERENCE, grain, dims, rate_rainy - rate_dry,
              F.col("n_rainy") + F.col("n_dry"), "raw difference"),
        F.when(
            F.col("n_adjusted").isNotNull(),
            _line(RAIN_DIFFERENCE_ADJUSTED, grain, dims,
                  F.try_divide(F.col("gap_sum"), F.col("n_adjusted")), F.col("n_adjusted"),
                  "within hour of day, weighted by rainy trips"),
        ),
        _line(RATE_RAINY, grain, dims, rate_rainy, F.col("n_rainy")),
        _line(RATE_DRY, grain, dims, rate_dry, F.col("n_dry")),
    ]
    return scopes.select(F.inline(F.array_compact(F.array(*lines))))


def m4_wet_hours(dim_hour: DataFrame, settings: Settings) -> DataFrame:
    hours = dim_hour.where("weather_available").agg(
        F.count("*").alias("hours"),
        F.count_if("is_rainy").alias("wet"),
        F.count_if("is_rainy_moderate").alias("wet_high"),
    )
    mm, mm_high = settings.rain_thresholds
    note = "hours of the month at or above threshold"
    lines = [
        _line(WET_HOURS, "month", threshold_text(t), F.col(c), F.col("hours"), note)
        for t, c in ((mm, "wet"), (mm_high, "wet_high"))
    ]
    return hours.select(F.inline(F.array(*lines)))


def with_unavailable(rain: DataFrame, dim_hour: DataFrame) -> DataFrame:
    """The rain lines, or one UNAVAILABLE line per rain metric when no hour has weather."""
    known = dim_hour.agg(F.coalesce(F.bool_or("weather_available"), F.lit(False)).alias("known"))
    lines = [
        _line(m, "month", "", F.lit(None), F.lit(0), UNAVAILABLE) for m in RAIN_METRICS
    ]
    missing = known.where(~F.col("known")).select(F.inline(F.array(*lines)))
    return rain.where(known.scalar()).unionByName(missing)


def m5_trust(cube: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Shares of rows in (clean + quarantined) that are trusted, wait-eligible and dwell-covered,
    and the share each REJECT rule took; a rule that took nothing has no line."""
    n = F.col("n")
    clean = cube.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("trusted"),
        F.coalesce(F.sum(F.when(F.col("wait_ok"), n)), F.lit(0)).alias("wait"),
        F.coalesce(F.sum(F.when(F.col("dwell_ok"), n)), F.lit(0)).alias("dwell"),
    )
    per_rule = quarantine.groupBy("rule_id").agg(F.count("*").alias("n"))
    # one entry per REJECT rule at most
    taken = per_rule.agg(
        F.collect_list(F.struct("rule_id", "n")).alias("rules"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("taken"),
    )
    one = align([], clean, taken.select("taken")).withColumn(
        "rules", taken.select("rules").scalar()
    )
    one = one.withColumn("rows_in", F.col("trusted") + F.col("taken"))

    def share(c: Column) -> Column:
        return F.try_divide(c.cast("double"), F.col("rows_in"))

    rows_in = F.col("rows_in")
    fixed = F.array(
        _line("M5_trusted_row_share", "month", "", share(F.col("trusted")), rows_in,
              "not quarantined"),
        _line("M5_wait_eligible_share", "month", "", share(F.col("wait")), rows_in,
              "rows that enter the KPI"),
        _line("M5_dwell_coverage", "month", "", share(F.col("dwell")), rows_in,
              "rows with on_scene < pickup"),
    )
    per_rule_lines = F.transform(
        "rules",
        lambda r: _line(
            "M5_rule_share",
            "rule",
            F.concat(F.lit("rule_id="), r["rule_id"], F.lit("|severity=REJECT")),
            share(r["n"]),
            r["n"],
            "primary reject rule",
        ),
    )
    return one.select(F.inline(F.concat(fixed, per_rule_lines)))


# ------------------------------------------------------------------ the whole table


def finish(metrics: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    return metrics.select(
        "metric",
        "grain",
        "dimensions",
        F.round("value", decimals).alias("value"),
        F.col("n").cast("bigint").alias("n"),
        F.coalesce("note", F.lit("")).alias("note"),
    )


def metric_table(
    star: Star,
    quarantine: DataFrame,
    rules: Sequence[Rule],
    settings: Settings,
    cube: DataFrame | None = None,
) -> DataFrame:
    """All metric lines of a month, rounded; order it by (metric, grain, dimensions) at the sink."""
    cube = late_cube(star, rules, settings) if cube is None else cube
    rain = m4_rain(cube, settings).unionByName(m4_wet_hours(star.dim_hour, settings))
    blocks = [
        rate_lines(cube, settings),
        m2_month(star, rules),
        m3_median_dwell(star, rules),
        with_unavailable(rain, star.dim_hour),
        m5_trust(cube, quarantine),
    ]
    return finish(reduce(lambda a, b: a.unionByName(b), blocks))


def headline_check(metrics: DataFrame, settings: Settings) -> DataFrame:
    """One row: the KPI, whether it is a share, and which metric families are present."""
    kpi = late_metric(settings.late_minutes)
    headline = (
        (F.col("metric") == kpi) & (F.col("grain") == "month") & (F.col("dimensions") == "")
    )
    value = F.max(F.when(headline, F.col("value")))
    families = [f"M{i}" for i in range(1, 6)]
    present = F.collect_set(F.substring("metric", 1, 2))
    return metrics.agg(
        value.alias("kpi"),
        F.coalesce(value.between(0, 1), F.lit(False)).alias("kpi_is_share"),
        F.array_join(F.array_except(F.array(*[F.lit(f) for f in families]), present), ",").alias(
            "missing_families"
        ),
    )


def require_headline(metrics: DataFrame, settings: Settings) -> float:
    """Raise unless the KPI exists, is a share, and every family is present."""
    check = headline_check(metrics, settings).first()
    if check["kpi"] is None:
        raise MetricsCheckError("metrics are empty or the headline KPI is missing")
    if not check["kpi_is_share"]:
        raise MetricsCheckError(f"KPI {check['kpi']} is outside [0, 1]")
    if check["missing_families"]:
        raise MetricsCheckError(f"metric table lacks {check['missing_families']}")
    return check["kpi"]


def kpi_wait_histogram(star: Star, rules: Sequence[Rule]) -> DataFrame:
    """Log histogram of the waits behind the KPI."""
    from tallygate.operators.profile import log_histogram

    return log_histogram(star.fact_trip.where(eligible(rules, "wait")), "wait_minutes")
