"""The whole batch on files: sources, written tables, exports, gates and rerun identity."""

import glob
import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from trip_rows import TRIP_SCHEMA, minutes, trip, trip_rows

from tallygate.bindings import TRIP_FILE_ROLES, ZONE_FILE_ROLES, unbind
from tallygate.functions.hashing import fingerprint
from tallygate.operators import completeness as chk
from tallygate.operators.sampling import SampleSourceError
from tallygate.operators.validate import TrustFloorError
from tallygate.plans.monthly import current_run, load_source, run_month
from tallygate.plans.sample import run_sample
from tallygate.session import checkpoint_folder
from tallygate.settings import Settings
from tallygate.sources import fingerprints, readers
from tallygate.sources.intermediates import intermediates, shared_table
from tallygate.sources.orders import report
from tallygate.sources.writers import (
    export_ordered_parquet,
    export_report,
    materialise,
    write_report,
)

SETTINGS = Settings(min_cell_trips=1)


def month_of_trips():
    start = datetime(2026, 7, 1)
    rows = []
    for i in range(744):
        t = start + timedelta(hours=i, minutes=5, seconds=7)
        wait = 4 if i % 5 else 14
        rows.append(
            trip(
                request_ts=t,
                on_scene_ts=t + minutes(wait - 1),
                pickup_ts=t + minutes(wait),
                dropoff_ts=t + minutes(wait + 24),
                pu_zone_id=i % 263 + 1,
                company_id="HV0003" if i % 3 else "HV0005",
            )
        )
    rows[40] = rows[40] | {"on_scene_ts": rows[40]["request_ts"] - minutes(3)}
    return rows


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sources")
    write = lambda df, name: df.coalesce(1).write.parquet(f"{root}/{name}")
    rows = month_of_trips()
    trips = spark.createDataFrame(trip_rows(rows), TRIP_SCHEMA).drop("trip_id")
    write(unbind(trips, TRIP_FILE_ROLES), "trips")
    broken = [r | {"trip_miles": 900.0} if i % 10 == 0 else r for i, r in enumerate(rows)]
    bad = spark.createDataFrame(trip_rows(broken), TRIP_SCHEMA).drop("trip_id")
    write(unbind(bad, TRIP_FILE_ROLES), "untrusted")
    write(unbind(trips, TRIP_FILE_ROLES).drop("tips"), "drifted")
    zones = spark.range(1, 266).select(
        F.col("id").alias("zone_id"), F.lit("Queens").alias("borough"),
        F.concat(F.lit("Z"), "id").alias("zone"),
        F.when(F.col("id").isin(132, 138), "Airports").otherwise("Boro Zone").alias("service_zone"),
    )
    unbind(zones, ZONE_FILE_ROLES).coalesce(1).write.option("header", True).csv(f"{root}/zones")
    labels = [datetime(2026, 7, 1) + timedelta(hours=i) for i in range(768)]
    document = {
        "timezone": "GMT", "latitude": 40.8, "longitude": -74.0,
        "hourly": {
            "time": [f"{t:%Y-%m-%dT%H:%M}" for t in labels],
            "precipitation": [1.0 if i % 4 == 0 else 0.0 for i in range(768)],
            "temperature_2m": [20.0] * 768,
            "weather_code": [1] * 768,
        },
    }
    (root / "weather.json").write_text(json.dumps(document))
    (root / "report.csv").write_text(
        '﻿Month/Year,License Class,Trips Per Day,Other\n2026-07,FHV - High Volume,"24",x\n'
    )
    return root


def run(spark, sources, out, **changes):
    arguments = {
        "trips_path": f"{sources}/trips",
        "zones_path": f"{sources}/zones",
        "weather_path": f"{sources}/weather.json",
        "report_path": f"{sources}/report.csv",
        "settings": SETTINGS,
        "out": str(out),
        **changes,
    }
    return run_month(spark, **arguments)


def test_month_end_to_end_and_rerun_identity(spark, sources, tmp_path):
    first = run(spark, sources, tmp_path / "a")
    assert first.record["rows"]["rows_clean"] == 744
    assert first.record["sanity_band"]["status"] == "within_band"
    assert first.record["weather"]["local_hours_present"] == 744
    assert first.record["kpi"] == pytest.approx(148 / 743, abs=1e-6)
    assert first.record["model"]["event_rows"] == 4 * 744
    assert len(first.profile) == 17
    assert first.profile["wait_percentiles"].where("is_total").first()["n"] == 744
    assert first.tables["evidence"].count() == 19

    assert current_run(spark, f"{tmp_path}/a") == first.path
    (part,) = glob.glob(f"{first.path}/export/metrics/part-*.csv")
    lines = open(part, newline="").read().split("\n")
    assert lines[0] == "metric,grain,dimensions,value,n,note" and "\r" not in "".join(lines)
    assert any(x.startswith("M1_late_rate_10,month,,0.199192,743,") for x in lines)
    body = [x.split(",")[:3] for x in lines[1:-1]]
    assert body == sorted(body)

    # the written tables lie in their stated order
    def read_in_order(name, *columns):
        files = sorted(glob.glob(f"{first.path}/{name}/part-*.parquet"))
        return [tuple(r[c] for c in columns) for f in files
                for r in spark.read.parquet(f).collect()]

    stored = read_in_order("metrics", "metric", "grain", "dimensions")
    assert stored == sorted(stored) and len(stored) == len(body)
    ranks = read_in_order("incentive_cells", "list", "rank")
    assert ranks == sorted(ranks, key=lambda r: (r[0] == "airport", r[1] is None, r[1]))
    assert read_in_order("profile/wait_percentiles", "is_total")[0] == (True,)

    # a failing rerun, and changed content, leave the published run whole
    with pytest.raises(TrustFloorError):
        run(spark, sources, tmp_path / "a", trips_path=f"{sources}/untrusted")
    source = first.record["source"]
    with pytest.raises(chk.CompletenessError, match="fingerprint"):
        run(spark, sources, tmp_path / "a", trips_path=f"{sources}/untrusted",
            recorded=(source["n_rows"], source["content_sum"]))
    assert current_run(spark, f"{tmp_path}/a") == first.path
    assert spark.read.parquet(f"{first.path}/fact_trip").count() == 744

    second = run(spark, sources, tmp_path / "b",
                 recorded=(source["n_rows"], source["content_sum"]))
    for name in ("metrics", "incentive_cells", "fact_trip_event", "quarantine_trips"):
        same = chk.same_content(first.tables[name], second.tables[name]).first()
        assert same["identical"], name


def test_untrusted_month_publishes_nothing(spark, sources, tmp_path):
    with pytest.raises(TrustFloorError):
        run(spark, sources, tmp_path / "c", trips_path=f"{sources}/untrusted")
    assert not glob.glob(f"{tmp_path}/c/*/export/*") and not glob.glob(f"{tmp_path}/c/*/metrics/*")
    assert not glob.glob(f"{tmp_path}/c/current/*")


def test_missing_column_is_fatal(spark, sources, tmp_path):
    with pytest.raises(chk.CompletenessError, match="tips"):
        run(spark, sources, tmp_path / "d", trips_path=f"{sources}/drifted")


def test_run_without_weather(spark, sources, tmp_path):
    done = run(spark, sources, tmp_path / "e", weather_path=None, report_path=None)
    rain = done.tables["metrics"].where("metric LIKE 'M4%'")
    assert rain.count() == 5 and rain.where("value IS NOT NULL").count() == 0


def test_row_numbers_over_several_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 1000).repartition(6).write.parquet(path)
    rows = readers.read_with_row_number(spark, path)
    assert sorted(r["file_row_number"] for r in rows.collect()) == list(range(1000))
    in_order = [r["id"] for r in rows.orderBy("file_row_number").collect()]
    by_file = []
    for f in sorted(glob.glob(f"{path}/part-*.parquet")):
        by_file += [r["id"] for r in spark.read.parquet(f).collect()]
    assert in_order == by_file


def test_ordered_parquet(spark, tmp_path):
    path = str(tmp_path / "ordered")
    export_ordered_parquet(
        spark.range(500).selectExpr("499 - id AS id", "id AS v"), path, "id", ["v"]
    )
    files = sorted(glob.glob(f"{path}/part-*.zstd.parquet"))
    assert files and spark.read.parquet(path).columns == ["id"]
    ids = [r["id"] for f in files for r in spark.read.parquet(f).collect()]
    assert ids == list(range(500))


def test_source_is_scanned_once_for_load_count_and_fingerprint(spark, sources, tmp_path):
    trips = spark.read.parquet(f"{sources}/trips").withColumn("source_file", F.lit("f"))
    columns = [c for c in trips.columns if c != "source_file"]
    spark.sparkContext.setJobGroup("load", "load")
    loaded = load_source(trips, columns, columns, f"{tmp_path}/raw")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("load")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    want = fingerprint(trips.drop("source_file")).first()
    assert (loaded.n_rows, loaded.content_sum) == (want["n_rows"], want["content_sum"])


def test_file_fingerprints_name_the_changed_file(spark, tmp_path):
    path = f"{tmp_path}/parts"
    rows = spark.range(900).selectExpr("id", "id % 7 AS k")
    for i in range(3):
        rows.where(f"id % 3 = {i}").coalesce(1).write.mode("append").parquet(path)
    recorded = fingerprints.file_fingerprints(spark, path)
    recorded = spark.createDataFrame(recorded.collect(), recorded.schema)
    assert fingerprints.merged(recorded).first() == fingerprint(rows).first()
    assert fingerprints.part_changes(recorded, recorded, "file").count() == 0

    victim = sorted(glob.glob(f"{path}/part-*.parquet"))[1]
    other = f"{tmp_path}/other"
    table = spark.read.parquet(victim).withColumn("k", F.col("k") + 1)
    table.coalesce(1).write.parquet(other)
    (new,) = glob.glob(f"{other}/part-*.parquet")
    def sums(f):  # the checksum file beside it
        return "{}/.{}.crc".format(*f.rsplit("/", 1))

    for a, b in ((new, victim), (sums(new), sums(victim))):
        with open(a, "rb") as src, open(b, "wb") as dst:
            dst.write(src.read())
    # the unchanged files are taken from the record: a wrong record shows that they are not read
    marked = recorded.withColumn("content_sum", F.when(
        F.col("file").endswith(victim.rsplit("/", 1)[-1]), F.col("content_sum")).otherwise("5"))
    found = fingerprints.file_fingerprints(spark, path, marked)
    assert found.where("content_sum = '5'").count() == 2
    (change,) = fingerprints.part_changes(marked, found, "file").collect()
    assert change["status"] == "changed" and change["file"].endswith(victim.rsplit("/", 1)[-1])
    more = fingerprints.part_changes(recorded.limit(2), recorded, "file").collect()
    assert [r["status"] for r in more] == ["added"]


def test_sample_of_a_published_run(spark, sources, tmp_path):
    run(spark, sources, tmp_path / "m")
    few = replace(SETTINGS, sample_modulus=20, append_per_rule=3)
    made = run_sample(spark, f"{tmp_path}/m", f"{tmp_path}/s", few, trips_path=f"{sources}/trips")
    rows = spark.read.parquet(made.trips)
    full = spark.read.parquet(f"{sources}/trips")
    assert rows.columns == full.columns and rows.exceptAll(full).count() == 0
    assert rows.count() == made.record["rows"] < 200
    # parts follow each other in source order
    files = sorted(glob.glob(f"{made.trips}/part-*.parquet"))
    times = [r["pickup_datetime"] for f in files for r in spark.read.parquet(f).collect()]
    assert times == sorted(times)
    counts = {r["rule_id"]: r for r in made.rule_rows.collect()}
    assert counts["R12"]["rows_in_month"] == 1 and counts["R12"]["rows_in_sample"] == 1
    assert made.record["appended"] in ({"R12": [40]}, {})
    assert all(r["rows_in_sample"] for r in counts.values() if r["rows_in_month"])
    again = run_sample(spark, f"{tmp_path}/m", f"{tmp_path}/s2", few)
    assert chk.same_content(rows, spark.read.parquet(again.trips)).first()["identical"]
    with pytest.raises(SampleSourceError, match="changed"):
        run_sample(spark, f"{tmp_path}/m", f"{tmp_path}/s3", few, trips_path=f"{sources}/untrusted")


def test_intermediates_go_with_their_scope(spark):
    def made():
        folder = f"{checkpoint_folder(spark)}/tallygate/{spark.conf.get('spark.app.id')}"
        return {f for f in glob.glob(f"{folder.removeprefix('file://')}/*")}

    before = made()
    with intermediates(spark):
        assert materialise(spark.range(5), "five").count() == 5
        assert len(made() - before) == 1
    assert made() == before
    with pytest.raises(ValueError), intermediates(spark):
        materialise(spark.range(5), "five")
        raise ValueError
    assert made() == before


def test_shared_tables_follow_their_sources(spark, tmp_path):
    path, built = f"{tmp_path}/source", []

    def build():
        built.append(1)
        return spark.read.parquet(path)

    spark.range(10).write.parquet(path)
    first = shared_table(spark, "numbers", [path], build)
    assert shared_table(spark, "numbers", [path], build).count() == first.count() == 10
    assert len(built) == 1
    spark.range(4).write.mode("append").parquet(path)
    assert shared_table(spark, "numbers", [path], build).count() == 14 and len(built) == 2


def test_reports_are_written_in_their_order(spark, tmp_path):
    """Descending lists, ranks with NULLs last; profile tables with NULLs first."""
    rows = [("airport", 1, 9), ("neighbourhood", None, 3), ("neighbourhood", 2, 5),
            ("neighbourhood", 1, 8), ("airport", None, 1), ("neighbourhood", None, 2)]
    df = spark.createDataFrame(rows, "list string, rank int, pu_zone_id int").withColumns(
        {"dow": F.lit(1), "hour": F.lit(0)}).repartition(4)

    def read_in_order(path):
        files = sorted(glob.glob(f"{path}/part-*.parquet"))
        return [tuple(r)[:3] for f in files for r in spark.read.parquet(f).collect()]

    write_report(report("incentive_cells", df), f"{tmp_path}/cells")
    assert read_in_order(f"{tmp_path}/cells") == [rows[i] for i in (3, 2, 5, 1, 0, 4)]
    write_report(report("other", df), f"{tmp_path}/other")
    assert read_in_order(f"{tmp_path}/other") == [rows[i] for i in (4, 0, 5, 1, 3, 2)]
    export_report(report("incentive_cells", df), f"{tmp_path}/csv")
    (part,) = glob.glob(f"{tmp_path}/csv/part-*.csv")
    lines = open(part).read().split("\n")[1:-1]
    assert [x.split(",")[2] for x in lines] == ["8", "5", "2", "3", "9", "1"]
    with pytest.raises(ValueError):
        report("x", df, ["rank SIDEWAYS"]).ordered()
