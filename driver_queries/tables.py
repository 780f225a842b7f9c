"""The driver's tables in the roles the operators expect.

Two tables play the part of trips.  ``events`` gives row-level trips with a unique id; order lines
(``lineitem`` joined to ``orders``) give the larger table the profiles run on.  The expressions only
spread each row's own values over waits, arrivals and flags, so every rule has rows to act on.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.functions.derive import wall_hour
from tallygate.operators.metrics import late_cube
from tallygate.operators.stage import stage, with_durations
from tallygate.operators.star import Star, build_star
from tallygate.operators.validate import Split, split, with_hits
from tallygate.rules import DEFAULT_RULES
from tallygate.session import prepare
from tallygate.settings import Settings
from tallygate.sources.intermediates import shared_table

UNKNOWN_ZONES = (23, 24)

SETTINGS = Settings(
    month="2024-01",
    rain_mm=0.5,
    rain_mm_high=1.25,
    zone_count=25,
    unknown_zone_ids=UNKNOWN_ZONES,
    companies={
        "click": "Click cars",
        "error": "Error cars",
        "purchase": "Purchase cars",
        "signup": "Signup cars",
        "view": "View cars",
        "lapsed": "Lapsed cars",
    },
    companies_source="event types",
    zones_source="nation and region",
    min_cell_trips=4,
    sample_modulus=40,
)

RULES = DEFAULT_RULES

#: Months whose clock repeats an hour and skips one, and the days events are moved to lie in them.
CLOCK_CHANGES = {
    "april": (replace(SETTINGS, month="2024-04", timezone="Australia/Sydney"), 92),
    "october": (replace(SETTINGS, month="2024-10", timezone="Australia/Sydney"), 274),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _add(unit: str, amount: Column | str, ts: Column | str) -> Column:
    return F.timestamp_add(unit, F.expr(amount) if isinstance(amount, str) else amount,
                           F.col(ts) if isinstance(ts, str) else ts)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips in January 2024."""
    e = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.expr("cast(substring(props, 7, length(props) - 7) AS int)").alias("k"),
        F.round(F.col("value") * 100).cast("int").alias("cents"),
    )
    e = e.withColumn(
        "wait_s",
        F.expr(
            "CASE WHEN user_id % 37 = 5 THEN cents div 8 * 20 "
            "WHEN user_id % 11 = 3 THEN -(cents div 8) ELSE cents div 8 END"
        ),
    ).withColumn("ride_s", F.expr("k * 15 + user_id % 3 * 60"))
    e = e.withColumn("pickup_ts", _add("SECOND", "wait_s", "ts"))
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("event_type").alias("company_id"),
        F.expr("concat('B', user_id % 40)").alias("base_id"),
        F.expr("CASE WHEN k % 5 <> 0 THEN concat('B', k % 45) END").alias("originating_base_id"),
        F.col("ts").alias("request_ts"),
        F.when(F.expr("k % 13 = 0"), F.lit(None))
        .when(F.expr("k % 9 = 0"), F.col("pickup_ts"))
        .when(F.expr("user_id % 11 = 3 AND k % 10 = 1"), _add("SECOND", "30", "ts"))
        .when(F.expr("user_id % 11 = 3"), _add("SECOND", "-60", "ts"))
        .when(F.expr("k % 17 = 0"), _add("SECOND", "-90", "ts"))
        .otherwise(_add("SECOND", "wait_s div 2", "ts"))
        .alias("on_scene_ts"),
        "pickup_ts",
        _add(
            "SECOND",
            "CASE WHEN k % 25 = 3 THEN 0 WHEN k % 20 = 7 THEN ride_s + 200 ELSE ride_s END",
            "pickup_ts",
        ).alias("dropoff_ts"),
        F.expr("cast(user_id % 25 AS int)").alias("pu_zone_id"),
        F.expr("cast(k % 25 AS int)").alias("do_zone_id"),
        F.expr("CASE WHEN k % 30 = 11 THEN 0D ELSE cents / 2000D END").alias("trip_miles"),
        F.col("ride_s").cast("bigint").alias("trip_time"),
        F.expr("value - 1D").alias("base_passenger_fare"),
        F.expr("value * 0.75D - 0.05D").alias("driver_pay"),
        *[
            F.when(F.expr(p), "Y").otherwise("N").alias(c)
            for c, p in (
                ("shared_request_flag", "k % 6 = 0"),
                ("access_a_ride_flag", "k % 50 = 0"),
                ("wav_request_flag", "user_id % 10 = 0"),
                ("wav_match_flag", "user_id % 20 = 0"),
            )
        ],
    )


def faulty_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event trips with faults the plain ones lack: copies, trips of another month, companies
    that no dimension knows, trips without a zone."""
    n = F.col("trip_id")

    def moved(ts: str) -> Column:
        return F.when(n % 200 == 11, _add("DAY", "31", ts)).otherwise(F.col(ts)).alias(ts)

    trips = event_trips(spark, sf_dir)
    changed = {
        "company_id": F.when(n % 300 == 13, "ghost").otherwise(F.col("company_id")),
        "pu_zone_id": F.when(n % 400 != 17, F.col("pu_zone_id")),
        **{ts: moved(ts) for ts in ("request_ts", "on_scene_ts", "pickup_ts", "dropoff_ts")},
    }
    trips = trips.withColumns(changed)
    copies = F.when(n % 150 == 7, F.array(*map(F.lit, (0, 1, 2)))).when(
        n % 50 == 7, F.array(*map(F.lit, (0, 1)))).otherwise(F.array(F.lit(0)))
    return trips.withColumn("copy", F.explode(copies)).withColumn(
        "trip_id", n + F.col("copy") * F.lit(1_000_000_000_000)).drop("copy")


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips: a day between order and shipment counts as a minute of wait.

    Both sides of the join are large; it is a shuffle join on the order key unless Spark measures
    one side to be small, and a hot order key is split by the adaptive skew join.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    j = lines.join(orders, "l_orderkey").withColumn(
        "request_ts", _add("SECOND", "cast(l_orderkey % 86400 AS int)", "o_orderdate")
    )
    j = j.withColumn("pickup_ts", _add("MINUTE", "datediff(l_shipdate, o_orderdate)",
                                       "request_ts"))
    trips = j.select(
        F.col("l_returnflag").alias("company_id"),
        "request_ts",
        F.when(
            F.expr("l_linenumber <> 7"), _add("MINUTE", "10 * (l_linenumber - 4)", "pickup_ts")
        ).alias("on_scene_ts"),
        "pickup_ts",
        _add("HOUR", "cast(l_quantity - 1 AS int)", "pickup_ts").alias("dropoff_ts"),
        F.expr("cast(o_custkey % 25 AS int)").alias("pu_zone_id"),
        F.expr("cast(l_suppkey % 25 AS int)").alias("do_zone_id"),
        F.expr("CASE WHEN l_discount = 0 THEN 0D ELSE l_extendedprice / 1000D END").alias(
            "trip_miles"
        ),
        F.expr(
            "cast(l_quantity - 1 AS bigint) * 3600 + (l_linenumber - 4) * 60"
        ).alias("trip_time"),
        F.expr("o_totalprice - l_extendedprice").alias("base_passenger_fare"),
        F.expr("l_extendedprice * (l_discount - l_tax)").alias("driver_pay"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("wav_request_flag"),
        F.when(F.expr("l_linenumber % 2 = 0"), "Y").otherwise("N").alias("wav_match_flag"),
    )
    return with_durations(trips)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs; two zones are unknown, three are airports."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("zone_id"),
        F.expr(
            "CASE n_nationkey WHEN 23 THEN 'Unknown' WHEN 24 THEN 'N/A' ELSE r_name END"
        ).alias("borough"),
        F.expr(
            "concat(n_name, CASE WHEN n_nationkey IN (3, 8, 17) THEN ' Airport' ELSE '' END)"
        ).alias("zone"),
        F.expr(
            "CASE WHEN n_nationkey IN (3, 17) THEN 'Airports' WHEN n_nationkey = 8 THEN 'EWR' "
            "ELSE 'Boro Zone' END"
        ).alias("service_zone"),
    )


def shifted_events(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Events of another month: every time that many days later."""
    return table(spark, sf_dir, "events").withColumn("ts", _add("DAY", F.lit(days), "ts"))


def weather(spark: SparkSession, sf_dir: str, days: int = 0) -> DataFrame:
    """Hourly error events as the weather feed; hours are labelled as UTC."""
    errors = shifted_events(spark, sf_dir, days).where("event_type = 'error'")
    hourly = errors.groupBy(wall_hour("ts").alias("hour")).agg(
        F.count("*").alias("n"), F.min("user_id").alias("lo"), F.max("user_id").alias("hi")
    )
    return hourly.select(
        F.lit("GMT").alias("timezone"),
        F.lit(40.8).alias("grid_latitude"),
        F.lit(-74.0).alias("grid_longitude"),
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time_utc"),
        (F.col("n") % 8 / F.lit(4.0)).alias("precipitation"),
        F.col("lo").cast("double").alias("temperature_2m"),
        (F.col("hi") % 100).alias("weather_code"),
    )


def weather_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as one document of parallel hourly arrays, at most one entry per hour."""
    rows = weather(spark, sf_dir)
    values = ("time_utc", "precipitation", "temperature_2m", "weather_code")
    entries = F.array_sort(F.collect_list(F.struct(*values)))
    packed = rows.groupBy("timezone", "grid_latitude", "grid_longitude").agg(entries.alias("e"))
    return packed.select(
        "timezone",
        F.col("grid_latitude").alias("latitude"),
        F.col("grid_longitude").alias("longitude"),
        F.struct(
            F.col("e.time_utc").alias("time"), *[F.col(f"e.{v}").alias(v) for v in values[1:]]
        ).alias("hourly"),
    )


def _shared(spark: SparkSession, sf_dir: str, name: str, sources: str, build) -> DataFrame:
    """One written copy of a table for all queries over the same input."""
    paths = [f"{sf_dir}/{source}.parquet" for source in sources.split()]
    return shared_table(prepare(spark), name, paths, build)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged trips; the duplicate pass and the write are done once for all queries."""
    return _shared(spark, sf_dir, "stage", "events",
                   lambda: stage(event_trips(spark, sf_dir)))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_hits(staged(spark, sf_dir), RULES, SETTINGS)


def faulty_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _shared(spark, sf_dir, "faulty-stage", "events",
                     lambda: stage(faulty_trips(spark, sf_dir)))
    return with_hits(staged, RULES, SETTINGS)


def sides(spark: SparkSession, sf_dir: str) -> Split:
    return split(checked(spark, sf_dir), RULES)


def star_of(spark: SparkSession, sf_dir: str, clean: DataFrame) -> Star:
    """The star with its zone and hour dimensions written.

    Their size is then known when the fact is joined to them.  Left lazy, Spark would estimate them
    from the feed behind them and shuffle the fact on a few hundred hour keys.
    """
    built = build_star(clean, zones(spark, sf_dir), weather(spark, sf_dir), RULES, SETTINGS)
    return built._replace(
        dim_zone=_shared(spark, sf_dir, "dim-zone", "nation region", lambda: built.dim_zone),
        dim_hour=_shared(spark, sf_dir, "dim-hour", "events", lambda: built.dim_hour),
    )


def late_cube_of(spark: SparkSession, sf_dir: str, star: Star) -> DataFrame:
    return _shared(spark, sf_dir, "late-cube", "events nation region",
                   lambda: late_cube(star, RULES, SETTINGS))


def star(spark: SparkSession, sf_dir: str) -> Star:
    return star_of(spark, sf_dir, sides(spark, sf_dir).clean)
