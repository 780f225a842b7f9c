"""Sinks: tables, decimal CSV exports, ordered Parquet exports and the run record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygate.sources.intermediates import new_folder
from tallygate.sources.orders import Report, sort_term

DECIMALS = 6


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a Parquet table and return it as read back.

    Later stages start from the written files, so a lost executor costs a re-read, not a re-run.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # the written schema is known: skip inference, and keep an empty table readable
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once, to the cluster's shared checkpoint folder, and read it.

    For results that several later branches need: each branch then reads only the columns it uses
    from files, instead of repeating the work or re-running it after an executor is lost.
    ``intermediates`` says when it is deleted.
    """
    return write_table(df, new_folder(df.sparkSession, name))


def fixed_decimals(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """DOUBLE columns as text with a fixed number of decimals; NULL stays empty."""

    def text(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            formatted = F.format_string(f"%.{decimals}f", c)
            return F.when(c.isNotNull(), formatted).alias(field.name)
        return c

    return df.select(*[text(f) for f in df.schema])


def write_report(rows: Report, path: str) -> DataFrame:
    """Create or replace a report table whose files follow its order."""
    return write_table(rows.ordered(), path)


def export_report(rows: Report, path: str) -> None:
    """A report as CSV, in its order."""
    export_csv(rows.frame, path, [sort_term(t) for t in rows.order])


def export_csv(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Sorted CSV of a small result (the metric table, the eligible cells) as one part file.

    Both callers' results are bounded by dimensions (metric lines; zones x 168 hours), not by the
    number of trips.
    """
    ordered = df.orderBy(*order)
    (
        fixed_decimals(ordered)
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .option("lineSep", "\n")
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )


def export_ordered_parquet(df: DataFrame, path: str, order: str, drop: Sequence[str] = ()) -> None:
    """Range-sorted zstd Parquet: part files follow each other in ``order``."""
    (
        df.orderBy(order)
        .drop(*drop)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_record(df: DataFrame, path: str) -> None:
    """The small run-statistics table as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
