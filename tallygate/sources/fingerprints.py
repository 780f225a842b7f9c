"""Fingerprints of a source by part: which part changed, and which need not be read again.

A part (a file, a day, a company) has a row count and the sum of its row hashes.  Both add up, so
parts merge into the fingerprint of the whole whatever the order of rows or parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.functions.hashing import row_hash
from tallygate.sources.intermediates import identity

#: Columns of a table of file fingerprints.
FILES = "file string, bytes bigint, changed_at bigint, n_rows bigint, content_sum string"


def _summed(hashes: str) -> list:
    total = F.sum(F.col(hashes).cast("decimal(38,0)"))
    return [F.count("*").alias("n_rows"),
            F.coalesce(total, F.lit(0)).cast("string").alias("content_sum")]


def hashed_parts(df: DataFrame, part: str, hashes: str) -> DataFrame:
    """(part, n_rows, content_sum) from row hashes at hand; reads two columns."""
    return df.groupBy(part).agg(*_summed(hashes))


def part_fingerprints(df: DataFrame, part: str) -> DataFrame:
    """(part, n_rows, content_sum) of a table; the sums are combined before the shuffle."""
    columns = [c for c in df.columns if c != part]
    return hashed_parts(df.select(part, row_hash(df, columns).alias("_hash")), part, "_hash")


def merged(parts: DataFrame) -> DataFrame:
    """One row (n_rows, content_sum): the fingerprint of all parts together."""
    total = F.sum(F.col("content_sum").cast("decimal(38,0)"))
    return parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
                     F.coalesce(total, F.lit(0)).cast("string").alias("content_sum"))


def part_changes(before: DataFrame, after: DataFrame, part: str) -> DataFrame:
    """(part, rows_before, rows_after, status) of the parts that are not the same on both sides.

    ``status`` is changed, added or removed.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(part, F.struct("n_rows", "content_sum").alias(name))

    both = side(before, "b").join(side(after, "a"), part, "full")
    status = (F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed")
              .when(F.col("a") != F.col("b"), "changed"))
    return both.select(part, F.col("b.n_rows").alias("rows_before"),
                       F.col("a.n_rows").alias("rows_after"),
                       status.alias("status")).where("status IS NOT NULL")


def file_states(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, changed_at) of the files of a source; lists, reads nothing."""
    rows = [r for r in identity(spark, [path]) if r[0].rsplit("/", 1)[-1][0] not in "._"]
    return spark.createDataFrame(rows, "file string, bytes bigint, changed_at bigint")


def file_fingerprints(
    spark: SparkSession, path: str, recorded: DataFrame | None = None
) -> DataFrame:
    """Fingerprint of every Parquet file of a source, as ``FILES``.

    A file whose name, size and time of change are those of a ``recorded`` fingerprint is not read.
    """
    states = file_states(spark, path)
    known = None
    if recorded is not None:
        known = states.join(recorded.select("file", "bytes", "changed_at", "n_rows",
                                            "content_sum"), ["file", "bytes", "changed_at"])
        unread = states.join(known.select("file"), "file", "left_anti")
    else:
        unread = states
    # file names only: a listing, as long as the source has files
    names = [r["file"] for r in unread.select("file").collect()]
    found = None
    if names:
        df = spark.read.parquet(*names)
        name = F.col("_metadata.file_path")
        rows = df.select(name.alias("file"), row_hash(df, df.columns).alias("_hash"))
        found = unread.join(hashed_parts(rows, "file", "_hash"), "file", "left").select(
            "file", "bytes", "changed_at", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("content_sum", F.lit("0")).alias("content_sum"))
    if known is None:
        return found if found is not None else spark.createDataFrame([], FILES)
    known = known.select("file", "bytes", "changed_at", "n_rows", "content_sum")
    return known if found is None else known.unionByName(found)
