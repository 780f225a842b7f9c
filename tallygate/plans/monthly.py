"""The monthly batch: completeness, staging, validation, star schema, metrics, cells, exports.

Each stage ends in a written table and the next one starts from it, so work is done once, lineage
stays short, and losing executors costs a re-read.

A run writes only below its own folder, ``out/run=<id>``.  The last thing it writes is the small
record ``out/current``, which names that folder; a run that a gate stops leaves the published run
as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID, TRIP_FILE_ROLES
from tallygate.functions.hashing import hash_sample, modulus_for, row_hash
from tallygate.operators import cells as cell_ops
from tallygate.operators import completeness, inspect, metrics, profile, star, validate
from tallygate.operators.stage import stage
from tallygate.rules import DEFAULT_RULES, Rule
from tallygate.session import prepare
from tallygate.settings import TRIP_FILE_COLUMNS, Settings
from tallygate.sources import fingerprints, readers
from tallygate.sources.intermediates import intermediates
from tallygate.sources.orders import report as report_of
from tallygate.sources.writers import export_report, write_record, write_report, write_table


@dataclass
class MonthlyRun:
    """Tables of a finished run and the small record of what happened."""

    tables: dict[str, DataFrame]
    profile: dict[str, DataFrame]
    path: str
    record: dict[str, Any] = field(default_factory=dict)


def _merge_small(record: dict[str, Any], spark: SparkSession, path: str) -> None:
    rows = [(k, str(v)) for k, v in record.items()]
    write_record(spark.createDataFrame(rows, "item string, value string"), path)


def current_run(spark: SparkSession, out: str) -> str:
    """Folder of the run published last."""
    name = spark.read.schema("run string").json(f"{out}/current").first()["run"]
    return f"{out}/{name}"


@dataclass
class Loaded:
    table: DataFrame
    n_rows: int
    content_sum: str


def load_source(
    traced: DataFrame, columns: Sequence[str], source: Sequence[str], path: str
) -> Loaded:
    """Write a source with each row's hash; count and fingerprint are gathered by the same scan.

    ``source`` holds the columns' names in the source, which decide their order in the hash.
    """
    hashed = traced.withColumn("row_hash", row_hash(traced, columns, source))
    seen = Observation("load")
    total = F.sum(F.col("row_hash").cast("decimal(38,0)"))
    observed = hashed.observe(seen, F.count(F.lit(1)).alias("n_rows"), total.alias("content_sum"))
    table = write_table(observed, path)
    return Loaded(table, seen.get["n_rows"], str(seen.get["content_sum"] or 0))


def changed_files(spark: SparkSession, published: str, files: DataFrame) -> str:
    """The first files that differ from those of the published run, as text for a message."""
    try:
        before = spark.read.parquet(f"{current_run(spark, published)}/source_files")
    except AnalysisException:  # nothing published yet
        return ""
    named = fingerprints.part_changes(before, files, "file").orderBy("file").limit(10).collect()
    return "".join(f"; {r['status']}: {r['file']}" for r in named)


def run_month(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    out: str,
    weather_path: str | None = None,
    report_path: str | None = None,
    settings: Settings | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    sample_fraction: float | None = None,
    expected_columns: Sequence[str] = TRIP_FILE_COLUMNS,
    recorded: tuple[int, str] | None = None,
) -> MonthlyRun:
    """Run one month end to end; ``out`` is a folder every executor can reach.

    ``recorded`` is the (n_rows, content_sum) of an earlier run's source: with it, changed content
    stops the run, naming the changed files.  Every run records its own.  Intermediate tables are
    gone when the run ends or fails.
    """
    arguments = dict(locals())
    with intermediates(spark):
        return _run(**arguments)


def _run(
    spark: SparkSession, trips_path: str, zones_path: str, out: str, weather_path: str | None,
    report_path: str | None, settings: Settings | None, rules: Sequence[Rule],
    sample_fraction: float | None, expected_columns: Sequence[str],
    recorded: tuple[int, str] | None,
) -> MonthlyRun:
    published_to, run_id = out, f"run={uuid.uuid4().hex}"
    out = f"{out}/{run_id}"
    settings = settings or Settings()
    prepare(spark)
    record: dict[str, Any] = {"month": settings.month}

    # -- load: the source is read once; its count and fingerprint are observed while it is written
    traced = readers.load_trips(spark, trips_path, "source_file")
    roles = [c for c in traced.columns if c not in (ROW_ID, "source_file")]
    file_names = {role: c for c, role in TRIP_FILE_ROLES.items()}
    source = [file_names.get(c, c) for c in roles]
    missing = [c for c in expected_columns if c not in source]
    if missing:
        raise completeness.CompletenessError(f"trips: schema drift, missing column(s) {missing}")
    loaded = load_source(traced, roles, source, f"{out}/raw_trips")
    expected_rows = spark.read.parquet(trips_path).count()  # from file footers
    if loaded.n_rows != expected_rows:
        raise completeness.CompletenessError(
            f"rows lost on load: {loaded.n_rows} of {expected_rows}")
    trips = loaded.table.drop("source_file", "row_hash")
    states = fingerprints.file_states(spark, trips_path)
    found = fingerprints.hashed_parts(loaded.table, "source_file", "row_hash")
    files = write_table(
        states.join(found.withColumnRenamed("source_file", "file"), "file"), f"{out}/source_files")
    if recorded is not None and (loaded.n_rows, loaded.content_sum) != recorded:
        raise completeness.CompletenessError(
            "source content does not match its recorded fingerprint"
            + changed_files(spark, published_to, files))
    record["source"] = {"n_rows": loaded.n_rows, "content_sum": loaded.content_sum}
    record["extra_columns"] = [c for c in source if c not in expected_columns]

    # -- completeness
    hourly = completeness.hourly_completeness(trips, "pickup_ts", settings)
    record["completeness"] = completeness.require_complete(hourly.summary)
    zones = readers.load_zones(spark, zones_path)
    if not completeness.dense_key_check(zones, "zone_id", settings.zone_count).first()["is_dense"]:
        raise completeness.CompletenessError(f"zones: expected 1..{settings.zone_count} once each")
    if weather_path is not None:
        document = (
            spark.read.schema(readers.WEATHER_DOCUMENT_SCHEMA)
            .option("multiLine", True)
            .json(weather_path)
        )
        feed = readers.unnest_hourly(document, position="position")
        check = completeness.hourly_feed_check(feed, settings, "position")
        record["weather"] = completeness.require_feed(check)
    weather = readers.load_weather(spark, weather_path)
    if report_path is not None:
        report = readers.load_report(spark, report_path)
        record["sanity_band"] = (
            completeness.sanity_band(report, trips, settings).first().asDict()
        )

    # -- stage: derived columns and duplicate marks, written once
    modulus = modulus_for(sample_fraction)
    picked = hash_sample(trips, settings.business_key, modulus)
    staged = write_table(stage(picked), f"{out}/stage_trips")
    profiles = {
        name: write_report(report_of(name, df), f"{out}/profile/{name}")
        for name, df in profile.profile(staged, zones, settings).items()
    }

    # -- validation
    checked = validate.with_hits(staged, rules, settings)
    totals = write_table(validate.rule_totals(checked, rules), f"{out}/rule_totals")
    record["rule_counts"] = [
        r.asDict() for r in validate.rule_counts(checked, rules, totals).collect()
    ]
    record["trust"] = validate.trust_gate(checked, rules, settings, totals)
    sides = validate.split(checked, rules)
    quarantine = write_table(sides.quarantine, f"{out}/quarantine_trips", ["rule_id"])
    clean = write_table(sides.clean, f"{out}/clean_trips")
    kept = validate.reconciliation(clean, quarantine, staged).first()
    if not kept["reconciles"]:
        raise star.StarCheckError("clean + quarantined rows do not add up to rows in")
    record["rows"] = kept.asDict()

    # -- star schema
    built = star.build_star(clean, zones, weather, rules, settings)
    fact = write_table(built.fact_trip, f"{out}/fact_trip")
    dims = {
        name: write_table(getattr(built, name), f"{out}/{name}")
        for name in ("dim_zone", "dim_company", "dim_base", "dim_hour")
    }
    events = write_table(star.fact_trip_event(fact, rules), f"{out}/fact_trip_event")
    model = star.Star(**dims, fact_trip=fact, fact_trip_event=events)
    expected_hours = completeness.real_hours(spark, settings).count()
    record["model"] = star.check_star(
        star.star_statistics(model, clean, rules), expected_hours
    )

    # -- metrics and cells
    cube = write_table(metrics.late_cube(model, rules, settings), f"{out}/late_cube")
    lines = write_report(
        report_of("metrics", metrics.metric_table(model, quarantine, rules, settings, cube)),
        f"{out}/metrics")
    record["kpi"] = metrics.require_headline(lines, settings)
    ranked = write_report(
        report_of("incentive_cells",
               cell_ops.rank_cells(fact, model.dim_zone, rules, settings, cube)),
        f"{out}/incentive_cells")
    published = cell_ops.eligible_cells(ranked)

    # -- exports: small, sorted, only reached when every gate passed
    export_report(report_of("metrics", lines), f"{out}/export/metrics")
    export_report(report_of("incentive_cells", published), f"{out}/export/incentive_cells")
    companies = [c for c in ("HV0003", "HV0005") if c in settings.companies]
    tables = {
        "stage_trips": staged,
        "quarantine_trips": quarantine,
        "clean_trips": clean,
        **model._asdict(),
        "metrics": lines,
        "incentive_cells": ranked,
        "kpi_variants": write_report(
            report_of("kpi_variants", validate.kpi_variants(checked, rules, settings)),
            f"{out}/kpi_variants"),
        "kpi_by_segment": write_report(
            report_of("kpi_by_segment", validate.kpi_by_segment(clean, rules, settings)),
            f"{out}/kpi_by_segment"),
        "promotion_check": validate.promotion_check(clean, rules, settings),
        "evidence": inspect.evidence(lines, settings, companies),
        "top_neighbourhood_cells": inspect.top_neighbourhood_cells(ranked, settings.top_n),
        "top_airport_cells": inspect.top_airport_cells(ranked, settings.airport_top_n),
        "airport_share": inspect.airport_share(ranked, settings),
        "rain_against_spread": inspect.rain_against_spread(lines, settings),
        "rain_pairs": inspect.rain_pairs(lines, settings),
        "heatmap_grid": inspect.heatmap_grid(lines, settings),
        "kpi_wait_histogram": metrics.kpi_wait_histogram(model, rules),
    }
    _merge_small(record, spark, f"{out}/export/run_record")
    write_record(spark.createDataFrame([(run_id,)], "run string"), f"{published_to}/current")
    return MonthlyRun(tables, profiles, out, record)
