"""One callable per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import tables as t
from driver_queries.tables import RULES, SETTINGS
from tallygate.functions.derive import minutes_between
from tallygate.functions.hashing import hash_sample
from tallygate.functions.quantiles import Quantile, exact_quantiles
from tallygate.operators import cells as ce
from tallygate.operators import completeness as chk
from tallygate.operators import inspect as ins
from tallygate.operators import metrics as m
from tallygate.operators import profile as pf
from tallygate.operators import sampling as smp
from tallygate.operators import star as md
from tallygate.operators import validate as vr
from tallygate.operators.duplicates import mark_exact_duplicates
from tallygate.operators.stage import with_durations
from tallygate.plans.sample import revalidated_counts
from tallygate.rules import row_rules
from tallygate.sources import readers
from tallygate.sources.fingerprints import part_changes, part_fingerprints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DOCUMENT_COLUMNS = ("text", "lang", "source", "n_chars")


def tidy(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and doubles to six decimals, so two engines can be compared by value."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(c, 6) + F.lit(0.0)).alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema])


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(f(spark, sf_dir))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        return f

    return register


# ------------------------------------------------------------------ sources


@query("src1_row_lineage")
def _(s, d):
    rows = readers.read_with_row_number(t.prepare(s), f"{d}/events.parquet")
    return rows.select("event_id", "file_row_number")


@query("src4_weather_unnest")
def _(s, d):
    rows = readers.unnest_hourly(t.weather_document(s, d), position="position")
    return rows.drop("grid_latitude", "grid_longitude")


# ------------------------------------------------------------------ completeness


def _hourly(s, d):
    return chk.hourly_completeness(t.table(s, d, "events"), "ts", SETTINGS)


@query("chk1_hourly_counts")
def _(s, d):
    return chk.hourly_counts(t.table(s, d, "events"), "ts")


@query("chk3_hours_of_month_with_rows")
def _(s, d):
    """Every real hour of the month with its UTC hour and row count."""
    hours = chk.real_hours(s, SETTINGS)
    counts = chk.hourly_counts(t.table(s, d, "events"), "ts")
    return hours.join(counts, "hour", "left").select(
        "utc_hour", "hour", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query("chk4_zero_hours")
def _(s, d):
    return _hourly(s, d).zero_hours


@query("chk5_outside_hours")
def _(s, d):
    """Pickups outside the month, by hour."""
    return chk.hourly_completeness(t.event_trips(s, d), "dropoff_ts", SETTINGS).outside_hours


@query("chk6_thin_hours")
def _(s, d):
    from dataclasses import replace

    busy = replace(SETTINGS, low_hour_share=0.6)
    return chk.hourly_completeness(t.table(s, d, "events"), "ts", busy).thin_hours


@query("chk8_hourly_summary")
def _(s, d):
    return _hourly(s, d).summary


@query("chk10_dense_keys")
def _(s, d):
    return chk.dense_key_check(t.table(s, d, "nation"), "n_nationkey", 25, first=0)


@query("chk14_weather_feed")
def _(s, d):
    feed = readers.unnest_hourly(t.weather_document(s, d), position="position")
    return chk.hourly_feed_check(feed, SETTINGS, "position")


@query("chk15_sanity_band")
def _(s, d):
    """An aggregate report with thousands commas, per event type, against the trips."""
    events = t.table(s, d, "events")
    report = events.groupBy("event_type").agg(
        F.format_number(F.floor(F.count("*") * 5 / 31), 0).alias("Trips Per Day")
    ).select(
        F.lit("2024-01").alias("Month/Year"),
        F.when(F.col("event_type") == "view", SETTINGS.license_class)
        .otherwise(F.col("event_type"))
        .alias("License Class"),
        "Trips Per Day",
    )
    return chk.sanity_band(report, events, SETTINGS)


@query("chk16_row_counts")
def _(s, d):
    return chk.same_row_count(t.event_trips(s, d), t.table(s, d, "events"))


@query("chk17_reconciliation")
def _(s, d):
    both = t.sides(s, d)
    return vr.reconciliation(both.clean, both.quarantine, t.event_trips(s, d))


@query("chk23_headline")
def _(s, d):
    return m.headline_check(_metrics(s, d), SETTINGS)


@query("chk26_same_content")
def _(s, d):
    # two reads, one of them altered: every hundredth order has another priority
    orders = t.table(s, d, "orders")
    odd = F.when(F.col("o_orderkey") % 100 == 0, F.lit("0")).otherwise(F.col("o_orderpriority"))
    return chk.same_content(orders, orders.withColumn("o_orderpriority", odd))


@query("chk26_row_differences")
def _(s, d):
    """Rows of one side missing from the other, with multiplicity."""
    lines = t.table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    left = lines.where("l_linenumber <= 5")
    right = lines.where("l_linenumber >= 2")
    return chk.row_differences(left, right).groupBy(
        "side", "l_returnflag", "l_linestatus", "l_linenumber"
    ).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ derived columns, duplicates


@query("prj_durations")
def _(s, d):
    return with_durations(t.event_trips(s, d)).select(
        "trip_id",
        "wait_minutes",
        "dwell_minutes",
        "trip_minutes",
        "timestamp_trip_minutes",
        "duration_gap_seconds",
        "speed_mph",
        minutes_between("request_ts", "on_scene_ts").alias("request_to_arrival_minutes"),
    )


@query("wn1_exact_duplicates")
def _(s, d):
    documents = t.table(s, d, "documents")
    return mark_exact_duplicates(documents, DOCUMENT_COLUMNS, "doc_id").select(
        "doc_id", "dup_rank", "dup_count"
    )


@query("ag5_exact_quantiles")
def _(s, d):
    lines = t.table(s, d, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    levels = {"p1": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    return exact_quantiles(
        lines,
        keys,
        [
            *[Quantile(a, "l_extendedprice * (1 - l_discount)", q) for a, q in levels.items()],
            Quantile("median_taxed_quantity", "l_quantity", 0.5, "l_tax > 0.05D"),
        ],
    )


# ------------------------------------------------------------------ profiles


for _name, _profile in {
    "pf1_wait_percentiles": pf.wait_percentiles,
    "pf2_wait_tail": lambda df: pf.wait_tail(df, company="R", label="company_r"),
    "pf3_wait_log_histogram": pf.wait_log_histogram,
    "pf4_negative_wait_by_segment": pf.negative_wait_by_segment,
    "pf5_negative_wait_vs_on_scene": pf.negative_wait_vs_on_scene,
    "pf7_prearranged_by_hour": pf.prearranged_by_hour,
    "pf8_whole_minute_request_by_wait": pf.whole_minute_request_by_wait,
    "pf9_on_scene_vs_pickup": pf.on_scene_vs_pickup,
    "pf10_dwell_where_measurable": pf.dwell_where_measurable,
    "pf11_implied_speed": pf.implied_speed,
    "pf12_implied_speed_bins": pf.implied_speed_bins,
    "pf13_timestamp_speed_check": pf.timestamp_speed_check,
    "pf14_duration_agreement": pf.duration_agreement,
    "pf16_other_counts": lambda df: pf.other_counts(df, SETTINGS),
}.items():
    query(_name)(lambda s, d, f=_profile: f(t.order_trips(s, d)))


@query("pf6_prearranged_signature")
def _(s, d):
    return pf.prearranged_signature(t.order_trips(s, d), t.zones(s, d))


@query("pf15_duplicates")
def _(s, d):
    documents = mark_exact_duplicates(t.table(s, d, "documents"), DOCUMENT_COLUMNS, "doc_id")
    return pf.duplicates(documents, ["lang", "n_chars"], "text")


@query("pf17_column_profile")
def _(s, d):
    return pf.column_profile(t.table(s, d, "orders"))


# ------------------------------------------------------------------ rules


@query("vr2_rule_hits")
def _(s, d):
    return t.checked(s, d).select("trip_id", *[r.hit for r in row_rules(RULES)])


@query("vr4_quarantine")
def _(s, d):
    q = t.sides(s, d).quarantine
    flags = [c for c in q.columns if c.startswith("flag_")]
    return q.select(
        "trip_id", "rule_id", F.array_join("reject_rules", ",").alias("reject_rules"), *flags
    )


@query("vr5_clean")
def _(s, d):
    c = t.sides(s, d).clean
    return c.select("trip_id", "wait_minutes", *[x for x in c.columns if x.startswith("flag_")])


@query("vr8_rule_counts")
def _(s, d):
    return vr.rule_counts(t.checked(s, d), RULES)


@query("vr9_trust_lines")
def _(s, d):
    return vr.trust_lines(t.checked(s, d), RULES)


@query("vr10_kpi_variants")
def _(s, d):
    return vr.kpi_variants(t.checked(s, d), RULES, SETTINGS)


@query("vr11_kpi_by_segment")
def _(s, d):
    return vr.kpi_by_segment(t.sides(s, d).clean, RULES, SETTINGS)


@query("vr12_promotion_check")
def _(s, d):
    return vr.promotion_check(t.sides(s, d).clean, RULES, SETTINGS)


# ------------------------------------------------------------------ star schema


@query("md1_dim_zone")
def _(s, d):
    return md.dim_zone(t.zones(s, d), SETTINGS)


@query("md2_dim_company_trips")
def _(s, d):
    """Companies with their trips; one configured company has none."""
    clean = t.sides(s, d).clean
    trips = clean.groupBy("company_id").agg(F.count("*").alias("trips"))
    return md.dim_company(clean, SETTINGS).join(trips, "company_id", "left").withColumn(
        "trips", F.coalesce("trips", F.lit(0))
    )


@query("md3_dim_base")
def _(s, d):
    return md.dim_base(t.sides(s, d).clean)


@query("md4_dim_hour")
def _(s, d):
    return md.dim_hour(t.weather(s, d), SETTINGS)


@query("md5_fact_trip")
def _(s, d):
    return t.star(s, d).fact_trip


@query("md6_fact_trip_event")
def _(s, d):
    return t.star(s, d).fact_trip_event


@query("md7_time_in_state")
def _(s, d):
    return md.time_in_state(t.star(s, d).fact_trip, RULES)


@query("md8_star_statistics")
def _(s, d):
    clean = t.sides(s, d).clean
    return md.star_statistics(t.star_of(s, d, clean), clean, RULES)


# ------------------------------------------------------------------ metrics


def _cube(s, d):
    return t.late_cube_of(s, d, t.star(s, d))


@query("m1a_late_rate")
def _(s, d):
    return m.m1_month(_cube(s, d), SETTINGS)


@query("m1b_late_rate_sensitivity")
def _(s, d):
    return m.m1_sensitivity(_cube(s, d), SETTINGS)


@query("m1c_late_rate_company_wav")
def _(s, d):
    return m.m1_company_wav(_cube(s, d), SETTINGS)


@query("m1d_late_rate_borough_hour")
def _(s, d):
    return m.m1_borough_hour(_cube(s, d), SETTINGS)


@query("m2_p90_wait")
def _(s, d):
    return m.m2_month(t.star(s, d), RULES)


@query("m3_dwell")
def _(s, d):
    star = t.star(s, d)
    coverage = m.m3_coverage(m.late_cube(star, RULES, SETTINGS, ("company_id",)))
    return m.m3_median_dwell(star, RULES).unionByName(coverage)


@query("m4a_rain")
def _(s, d):
    cube = _cube(s, d)
    return m.m4_rain(cube, SETTINGS).where(F.col("metric") != m.RAIN_DIFFERENCE_ADJUSTED)


@query("m4b_rain_hour_adjusted")
def _(s, d):
    cube = _cube(s, d)
    return m.m4_rain(cube, SETTINGS).where(F.col("metric") == m.RAIN_DIFFERENCE_ADJUSTED)


@query("m4c_wet_hours")
def _(s, d):
    return m.m4_wet_hours(t.star(s, d).dim_hour, SETTINGS)


@query("m5_trust")
def _(s, d):
    both = t.sides(s, d)
    cube = m.late_cube(t.star_of(s, d, both.clean), RULES, SETTINGS, ())
    return m.m5_trust(cube, both.quarantine)


@query("mx1_metrics_without_weather")
def _(s, d):
    """The whole metric table of a month whose weather feed is empty."""
    both = t.sides(s, d)
    empty = md.dim_hour(t.weather(s, d).where(F.lit(False)), SETTINGS)
    dry = t.star_of(s, d, both.clean)._replace(dim_hour=empty)
    return m.metric_table(dry, both.quarantine, RULES, SETTINGS)


@query("mx2_metric_table")
def _(s, d):
    return _metrics(s, d)


@query("hg1_kpi_wait_histogram")
def _(s, d):
    return m.kpi_wait_histogram(t.star(s, d), RULES)


# ------------------------------------------------------------------ cells


def _cells(s, d):
    star = t.star_of(s, d, t.sides(s, d).clean)
    cube = t.late_cube_of(s, d, star)
    return ce.rank_cells(star.fact_trip, star.dim_zone, RULES, SETTINGS, cube)


@query("ce1_city_rate")
def _(s, d):
    return ce.city_rate(t.star(s, d).fact_trip, RULES, SETTINGS)


@query("ce2_zone_baseline")
def _(s, d):
    return ce.zone_baseline(t.star(s, d).fact_trip, RULES, SETTINGS)


@query("ce3_cell_statistics")
def _(s, d):
    return ce.cell_statistics(t.star(s, d).fact_trip, RULES, SETTINGS)


@query("ce5_cell_ranking")
def _(s, d):
    return _cells(s, d).select(
        "pu_zone_id", "dow", "hour", "list", "eligible", "rank", "overall_rank", "n",
        "excess_late_trips"
    )


@query("ce6_eligible_cells")
def _(s, d):
    return ce.eligible_cells(_cells(s, d))


# ------------------------------------------------------------------ sampling


@query("smp1_hash_sample")
def _(s, d):
    trips = t.event_trips(s, d)
    return hash_sample(trips, SETTINGS.business_key, 10).select("trip_id", "company_id")


@query("smp2_rule_hits")
def _(s, d):
    both = t.sides(s, d)
    return smp.rule_hits(both.clean, both.quarantine, RULES)


@query("smp3_rare_rule_sample")
def _(s, d):
    hits = smp.hits_of(t.checked(s, d), RULES, SETTINGS)
    sample = smp.rare_rule_sample(t.event_trips(s, d), hits, RULES, SETTINGS)
    return sample.select("trip_id", "appended_for")


@query("smp5_rule_counts_month_and_sample")
def _(s, d):
    return smp.month_and_sample_counts(smp.hits_of(t.checked(s, d), RULES, SETTINGS))


# ------------------------------------------------------------------ inspection and report frames


def _metrics(s, d):
    both = t.sides(s, d)
    star = t.star_of(s, d, both.clean)
    cube = t.late_cube_of(s, d, star)
    return m.metric_table(star, both.quarantine, RULES, SETTINGS, cube)


@query("ins1_rule_examples")
def _(s, d):
    both = t.sides(s, d)
    rule = next(r for r in RULES if r.id == "R03")
    return ins.rule_examples(both.clean, both.quarantine, rule, 20)


@query("ins1_rule_example_totals")
def _(s, d):
    both = t.sides(s, d)
    parts = [ins.rule_example_total(both.clean, both.quarantine, r) for r in RULES
             if r.id in ("R01", "R12")]
    return parts[0].unionByName(parts[1])


@query("ins2_month_lines")
def _(s, d):
    return ins.month_lines(_metrics(s, d))


@query("rp1_evidence")
def _(s, d):
    return ins.evidence(_metrics(s, d), SETTINGS, ("purchase", "view"))


@query("rp2_top_neighbourhood_cells")
def _(s, d):
    return ins.top_neighbourhood_cells(_cells(s, d), SETTINGS.top_n)


@query("rp2_top_airport_cells")
def _(s, d):
    return ins.top_airport_cells(_cells(s, d), SETTINGS.airport_top_n)


@query("rp3_airport_share")
def _(s, d):
    return ins.airport_share(_cells(s, d), SETTINGS)


@query("rp4_rain_against_spread")
def _(s, d):
    return ins.rain_against_spread(_metrics(s, d), SETTINGS)


@query("rp5_rain_pairs")
def _(s, d):
    return ins.rain_pairs(_metrics(s, d), SETTINGS)


@query("rsh3_heatmap_grid")
def _(s, d):
    return ins.heatmap_grid(_metrics(s, d), SETTINGS)


# ------------------------------------------------------------------ clock changes


def _clock_queries(month: str) -> None:
    settings, days = t.CLOCK_CHANGES[month]

    @query(f"chk3_hours_of_{month}")
    def _(s, d):
        counts = chk.hourly_counts(t.shifted_events(s, d, days), "ts")
        return chk.real_hours(s, settings).join(counts, "hour", "left").select(
            "utc_hour", "hour", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
        )

    @query(f"chk4_zero_hours_{month}")
    def _(s, d):
        """Hours of the month without an error event; the skipped hour is none of them."""
        errors = t.shifted_events(s, d, days).where("event_type = 'error'")
        return chk.hourly_completeness(errors, "ts", settings).zero_hours

    @query(f"chk5_outside_hours_{month}")
    def _(s, d):
        """Rows labelled with an hour the clock never showed."""
        return chk.hourly_completeness(t.shifted_events(s, d, days), "ts", settings).outside_hours

    @query(f"md4_dim_hour_{month}")
    def _(s, d):
        return md.dim_hour(t.weather(s, d, days), settings)


for _month in t.CLOCK_CHANGES:
    _clock_queries(_month)

# ------------------------------------------------------------------ faults the plain trips lack


def _faulty_sides(s, d):
    return vr.split(t.faulty_checked(s, d), RULES)


@query("chk5_outside_hours_faulty")
def _(s, d):
    return chk.hourly_completeness(t.faulty_trips(s, d), "pickup_ts", SETTINGS).outside_hours


@query("chk16_row_counts_faulty")
def _(s, d):
    """A load with more rows than its source."""
    return chk.same_row_count(t.faulty_trips(s, d), t.table(s, d, "events"))


@query("chk17_reconciliation_faulty")
def _(s, d):
    """Against a source that lacks the copies: the sides do not add up."""
    both = _faulty_sides(s, d)
    return vr.reconciliation(both.clean, both.quarantine, t.event_trips(s, d))


@query("wn1_duplicates_faulty")
def _(s, d):
    rows = t.faulty_checked(s, d)
    return rows.where("dup_count > 1").select("trip_id", "dup_rank", "dup_count")


@query("vr2_rule_hits_faulty")
def _(s, d):
    return t.faulty_checked(s, d).select("trip_id", *[r.hit for r in row_rules(RULES)])


@query("vr4_quarantine_faulty")
def _(s, d):
    return _faulty_sides(s, d).quarantine.select(
        "trip_id", "rule_id", F.array_join("reject_rules", ",").alias("reject_rules")
    )


@query("vr7_survivors_faulty")
def _(s, d):
    return _faulty_sides(s, d).clean.select("trip_id", "company_id", "flag_r05_survivor")


@query("vr8_rule_counts_faulty")
def _(s, d):
    return vr.rule_counts(t.faulty_checked(s, d), RULES)


@query("md8_star_statistics_faulty")
def _(s, d):
    """Null keys and unknown companies are counted."""
    clean = _faulty_sides(s, d).clean
    return md.star_statistics(t.star_of(s, d, clean), clean, RULES)


# ------------------------------------------------------------------ samples and parts


@query("smp5_rule_rows_revalidated")
def _(s, d):
    """The month's rule hits beside those of the sample validated as a run of its own."""
    hits = smp.hits_of(t.checked(s, d), RULES, SETTINGS)
    sample = smp.rare_rule_sample(t.event_trips(s, d), hits, RULES, SETTINGS)
    counts = revalidated_counts(sample.drop("appended_for"), RULES, SETTINGS)
    month = hits.groupBy("rule_id").agg(F.count("*").alias("rows_in_month"))
    return smp.rule_rows_in_month_and_sample(month, counts, RULES)


@query("chk27_changed_parts")
def _(s, d):
    """Fingerprints by order day against those of a source in which some orders changed."""
    orders = t.table(s, d, "orders").select(
        F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("o_totalprice").cast("string").alias("price"))
    other = orders.where("day >= DATE'1995-02-01'").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 1000 == 0, "0").otherwise(
            F.col("o_orderpriority")))
    return part_changes(part_fingerprints(orders, "day"), part_fingerprints(other, "day"), "day")
