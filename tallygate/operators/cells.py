"""Decision cells: pickup zone x weekday x hour, ranked by excess late trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygate.functions.quantiles import (
    Quantile,
    exact_quantiles,
    median,
    quantiles_of_counts,
    roll_up,
    row_count,
    rows_known,
    rows_where,
    value_counts,
)
from tallygate.operators.star import late_column
from tallygate.rules import Rule, eligible
from tallygate.settings import Settings

CELL = ("pu_zone_id", "dow", "hour")
ZONE_MEDIAN = "zone_median_request_to_arrival_minutes"

EXPORT_COLUMNS = (
    "list",
    "rank",
    "overall_rank",
    "is_airport",
    "borough",
    "zone",
    "pu_zone_id",
    "dow",
    "hour",
    "n",
    "late_trips",
    "late_rate",
    "city_late_rate",
    "late_rate_excess",
    "excess_late_trips",
    "p90_wait_minutes",
    "median_request_to_arrival_minutes",
    "zone_median_request_to_arrival_minutes",
    "median_dwell_minutes",
)


def city_rate(fact: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """One row: the late rate every cell is compared with."""
    late = F.col(late_column(settings.late_minutes)).cast("int")
    return fact.where(eligible(rules, "wait")).agg(F.avg(late).alias("city_late_rate"))


def city_rate_of(cube: DataFrame) -> DataFrame:
    """The same from the count cube, without reading the fact."""
    kept = cube.where("wait_ok")
    return kept.agg(F.try_divide(F.sum("late_main").cast("double"), F.sum("measured"))
                    .alias("city_late_rate"))


def _cell_trips(fact: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    # a trip without a zone is in no cell; said here, because the later join to zones would imply
    # it for one read of the value counts only and so cost a second scan
    rows = fact.where(eligible(rules, "wait", "zone") & F.col("pu_zone_id").isNotNull())
    return rows.select(
        "pu_zone_id",
        F.col("request_dow").alias("dow"),
        F.col("request_hour").alias("hour"),
        "wait_minutes",
        "request_to_arrival_minutes",
        "dwell_minutes",
        F.col(late_column(settings.late_minutes)).alias("late"),
        eligible(rules, "dwell").alias("captured"),
    )


QUANTILES = (
    Quantile("p90_wait_minutes", "wait_minutes", 0.9),
    median("median_request_to_arrival_minutes", "request_to_arrival_minutes", "captured"),
    median("median_dwell_minutes", "dwell_minutes", "captured"),
)


TALLIES = (
    row_count(),
    rows_where("late_trips", "late"),
    rows_known("measured", "late"),
)


def _cell_counts(trips: DataFrame) -> DataFrame:
    return value_counts(trips, CELL, [q.measure for q in QUANTILES], TALLIES)


def zone_baseline_of(counts: DataFrame) -> DataFrame:
    """The zone medians from the cells' value counts: rolled up, not re-read from trips."""
    arrival = 1
    per_zone = (
        counts.where(F.col("m") == arrival)
        .groupBy("pu_zone_id", "m", "v")
        .agg(F.sum("c").alias("c"))
    )
    return quantiles_of_counts(
        per_zone, ["pu_zone_id"], [("zone_median_request_to_arrival_minutes", arrival, 0.5)]
    )


SPECS = [(q.alias, i, q.q) for i, q in enumerate(QUANTILES)]


def _with_rate(found: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("late_trips").cast("double"), F.col("measured"))
    return found.withColumn("late_rate", rate)


def cell_statistics(fact: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """Counts, late rate and quantiles per cell, before any join; one scan of the fact."""
    counts = _cell_counts(_cell_trips(fact, rules, settings))
    return _with_rate(quantiles_of_counts(counts, CELL, SPECS, TALLIES)).drop("measured")


def zone_baseline(fact: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """Each zone's own request-to-arrival median over the month."""
    trips = _cell_trips(fact, rules, settings)
    return exact_quantiles(
        trips,
        ["pu_zone_id"],
        [median(ZONE_MEDIAN, "request_to_arrival_minutes", "captured")],
    )


def cells_with_baseline(fact: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """Cell statistics with their zone's median beside them, from one scan of the fact.

    The value counts of the cells also count for their zone, so the zone is just a second scope of
    the same table; its result is then copied to its cells (at most 168 per zone).
    """
    counts = _cell_counts(_cell_trips(fact, rules, settings))
    scopes = F.array(
        F.struct(F.lit(False).alias("is_zone"), F.col("dow").alias("dow"),
                 F.col("hour").alias("hour")),
        F.struct(F.lit(True).alias("is_zone"), F.lit(None).cast("bigint").alias("dow"),
                 F.lit(None).cast("bigint").alias("hour")),
    )
    keys = ["is_zone", *CELL]
    both = roll_up(
        counts.select("pu_zone_id", "m", "v", "c", *[x.partial for x in TALLIES],
                      F.inline(scopes)),
        keys,
        TALLIES,
    )
    found = _with_rate(quantiles_of_counts(both, keys, SPECS, TALLIES))
    of_zone = F.when(F.col("is_zone"), F.col("median_request_to_arrival_minutes"))
    return (
        found.withColumn(ZONE_MEDIAN, F.max(of_zone).over(Window.partitionBy("pu_zone_id")))
        .where(~F.col("is_zone"))
        .drop("is_zone", "measured")
    )


def score_cells(
    fact: DataFrame, dim_zone: DataFrame, rules: Sequence[Rule], settings: Settings,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Cells with their zone, list, baseline and excess over the city rate.

    Zones join the cells, not the trips: a zone id is unique, so the result is the same and only
    zones x 168 rows take part.
    """
    zones = dim_zone.select(
        F.col("zone_id").alias("pu_zone_id"), "borough", "zone", "is_airport"
    )
    city = city_rate(fact, rules, settings) if cube is None else city_rate_of(cube)
    scored = (
        cells_with_baseline(fact, rules, settings)
        .join(zones, "pu_zone_id")
        .withColumn("city_late_rate", city.scalar())
    )
    excess = F.col("late_rate") - F.col("city_late_rate")
    return scored.withColumns(
        {
            "list": F.when(F.col("is_airport"), F.lit("airport")).otherwise(
                F.lit("neighbourhood")
            ),
            "late_rate_excess": excess,
            "excess_late_trips": excess * F.col("n"),
            "eligible": F.col("n") >= settings.min_cell_trips,
        }
    )


def rank_cells(
    fact: DataFrame, dim_zone: DataFrame, rules: Sequence[Rule], settings: Settings,
    cube: DataFrame | None = None,
) -> DataFrame:
    """Every cell; eligible ones carry a rank within their list and an overall rank.

    With the written count ``cube`` the city rate needs no second read of the fact.

    The ranking windows see cells, whose number is bounded by the zone dimension times 168.
    """
    scored = score_cells(fact, dim_zone, rules, settings, cube)
    order = [F.desc("excess_late_trips"), *CELL]
    in_list = Window.partitionBy("eligible", "list").orderBy(*order)
    overall = Window.partitionBy("eligible").orderBy(*order)
    return scored.withColumns(
        {
            "rank": F.when(F.col("eligible"), F.row_number().over(in_list)).cast("bigint"),
            "overall_rank": F.when(F.col("eligible"), F.row_number().over(overall)).cast("bigint"),
        }
    )


def eligible_cells(cells: DataFrame, decimals: int = 6) -> DataFrame:
    """The published columns of eligible cells, rounded; order by (list desc, rank) at the sink."""
    first = EXPORT_COLUMNS.index("late_rate")
    return cells.where("eligible").select(
        *EXPORT_COLUMNS[:first],
        *[F.round(c, decimals).alias(c) for c in EXPORT_COLUMNS[first:]],
    )
