"""The sample job: a small, deterministic copy of a published month in which every rule occurs.

It starts from the tables of a published full run, so the month is neither loaded nor staged again:
rows are picked by the hash of their business key, rules that then lack an example get their first
rows, and the sample is written in source order.  The written sample is validated as a run of its
own, and its rule counts are put beside the month's.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID, TRIP_FILE_ROLES, unbind
from tallygate.functions.hashing import modulus_for
from tallygate.operators import sampling, validate
from tallygate.operators.stage import stage
from tallygate.plans.monthly import current_run
from tallygate.rules import DEFAULT_RULES, Rule
from tallygate.session import prepare
from tallygate.settings import Settings
from tallygate.sources import fingerprints, readers
from tallygate.sources.intermediates import intermediates
from tallygate.sources.writers import export_ordered_parquet, materialise, write_record, write_table


@dataclass
class SampleRun:
    """Where the sample lies, its rule counts beside the month's, and what happened."""

    path: str
    trips: str
    rule_rows: DataFrame
    record: dict[str, Any] = field(default_factory=dict)


def revalidated_counts(
    sample: DataFrame, rules: Sequence[Rule], settings: Settings
) -> DataFrame:
    """Rule counts of a sample as a run of its own: staged, marked for duplicates and checked."""
    checked = validate.with_hits(stage(sample), rules, settings)
    return validate.rule_counts(checked, rules)


def run_sample(
    spark: SparkSession,
    published: str,
    out: str,
    settings: Settings | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    fraction: float | None = None,
    trips_path: str | None = None,
) -> SampleRun:
    """Cut a sample from the run published in ``published``; ``out`` is a shared folder.

    With ``trips_path`` the source is compared, file by file, with what the run loaded; a changed
    file stops the job.  So does a run that holds a sample itself.
    """
    prepare(spark)
    settings = settings or Settings()
    if fraction is not None:
        settings = settings.with_modulus(modulus_for(fraction))
    run = current_run(spark, published)
    raw = spark.read.parquet(f"{run}/raw_trips").drop("source_file", "row_hash")
    staged = spark.read.parquet(f"{run}/stage_trips")
    recorded = spark.read.parquet(f"{run}/source_files")
    if trips_path is not None:
        found = fingerprints.file_fingerprints(spark, trips_path, recorded)
        changes = fingerprints.part_changes(recorded, found, "file")
        bad = [tuple(r) for r in changes.select("file", "status").orderBy("file").limit(10).collect()]
        if bad:
            raise sampling.SampleSourceError(f"the source changed since the run: {bad}")
    sampling.require_full_run(raw, staged)
    record: dict[str, Any] = {"run": run, "source": fingerprints.merged(recorded).first().asDict(),
                              "modulus": settings.sample_modulus}

    path = f"{out}/sample={uuid.uuid4().hex}"
    with intermediates(spark):
        checked = validate.with_hits(staged, rules, settings)
        # (row, rule, in sample): read by the counts, the candidates and the report
        hits = materialise(sampling.hits_of(checked, rules, settings), "rule-hits")
        picked = sampling.rare_rule_sample(raw, hits, rules, settings)
        picked = materialise(picked, "sample")
        # the sample is what is sorted, by ranges of positions, not the month
        rows = unbind(picked.drop("appended_for"), TRIP_FILE_ROLES)
        export_ordered_parquet(rows, f"{path}/trips", ROW_ID, [ROW_ID])
        appended = picked.where("appended_for IS NOT NULL").groupBy("appended_for").agg(
            F.sort_array(F.collect_list(ROW_ID)).alias("ids"))  # at most append_per_rule a rule
        record["appended"] = {r["appended_for"]: r["ids"] for r in appended.collect()}
        written = readers.load_trips(spark, f"{path}/trips")
        record["rows"] = written.count()
        record["hash_sample_rows"] = record["rows"] - sum(map(len, record["appended"].values()))
        month = sampling.month_and_sample_counts(hits).select(
            "rule_id", F.col("month_rows").alias("rows_in_month"))
        counts = sampling.rule_rows_in_month_and_sample(
            month, revalidated_counts(written, rules, settings), rules)
        rule_rows = write_table(counts, f"{path}/rule_rows")
    fields = [(k, str(v)) for k, v in record.items()]
    write_record(spark.createDataFrame(fields, "item string, value string"), f"{path}/record")
    return SampleRun(path, f"{path}/trips", rule_rows, record)
