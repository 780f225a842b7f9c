"""Exact duplicates: rank and size of every group of equal rows, without a wide window.

A window over all columns would shuffle and sort every wide row, and put a hot group of copies
into one task.  Instead:

* the wide rows are read once to write ``(row id, hash)``; hashes that occur more than once come
  from that narrow table;
* only rows with such a hash are compared column by column, as counts of distinct rows that are
  combined before the shuffle.  A hash whose rows all agree is the id of their group; where they do
  not, the distinct rows are numbered and hash and number are the id;
* ranks are prefix sums: counts per (group, range of positions) give every range its offset, and a
  row's place in its range is added.  Ids and counts move, no compared column does; however many
  copies a group has, they spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygate.sources.writers import materialise

# Positions per chunk: the most rows of one group a single sort can meet.
CHUNK = 1 << 20


def _row_hash(columns: Sequence[str]) -> Column:
    cols = [F.col(c) for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def _marks(df: DataFrame, columns: Sequence[str], row_id: str) -> DataFrame:
    """``(row_id, h, variant)`` of the rows whose hash is not alone; equal rows share both.

    ``variant`` is 0 unless different rows share the hash.
    """
    hashes = materialise(df.select(row_id, _row_hash(columns).alias("h")), "row-hashes")
    repeated = hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    marks = hashes.join(repeated, "h", "left_semi").select(row_id, "h")
    suspects = df.select(row_id, *columns, _row_hash(columns).alias("h")).join(
        repeated, "h", "left_semi")
    distinct = suspects.groupBy("h", *columns).agg(F.lit(1).alias("one"))
    clashing = distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    agreed = marks.withColumn("variant", F.lit(0))
    # none as a rule: two different rows with one 64-bit hash
    if clashing.isEmpty():
        return agreed
    clashing = materialise(clashing, "hash-clashes")
    agreed = agreed.join(clashing, "h", "left_anti").select(row_id, "h", "variant")
    order = Window.partitionBy("h").orderBy(*columns)
    numbered = distinct.join(clashing, "h", "left_semi").select(
        F.col("h").alias("n_h"), *[F.col(c).alias(f"n_{c}") for c in columns],
        F.row_number().over(order).alias("variant"))
    same = F.col("h") == F.col("n_h")
    for c in columns:
        same &= F.col(c).eqNullSafe(F.col(f"n_{c}"))
    return agreed.unionByName(suspects.join(numbered, same).select(row_id, "h", "variant"))


def duplicate_ranks(
    df: DataFrame, columns: Sequence[str], row_id: str, chunk: int = CHUNK
) -> DataFrame:
    """``(row_id, dup_rank, dup_count)`` for the rows that have at least one exact copy.

    Runs the jobs that hash and verify the rows.
    """
    group = ["h", "variant"]
    marks = _marks(df, columns, row_id).withColumn(
        "chunk", F.floor(F.col(row_id) / F.lit(chunk)))
    per_chunk = marks.groupBy(*group, "chunk").agg(F.count("*").alias("c"))
    whole = Window.partitionBy(*group)
    totals = per_chunk.select(
        *group,
        "chunk",
        (F.sum("c").over(whole.orderBy("chunk")) - F.col("c")).alias("before"),
        F.sum("c").over(whole).alias("dup_count"),
    )
    inside = Window.partitionBy(*group, "chunk").orderBy(row_id)
    ranked = marks.withColumn("rn", F.row_number().over(inside))
    return (
        ranked.join(totals.where("dup_count > 1"), [*group, "chunk"])
        .select(
            row_id,
            (F.col("before") + F.col("rn")).cast("bigint").alias("dup_rank"),
            F.col("dup_count").cast("bigint").alias("dup_count"),
        )
    )


def mark_exact_duplicates(
    df: DataFrame, columns: Sequence[str], row_id: str, chunk: int = CHUNK
) -> DataFrame:
    """``df`` plus ``dup_rank`` (1 = first copy by ``row_id``) and ``dup_count``.

    Writes the ranks of repeated rows first.  Spark then knows their size when it plans the join:
    none or few are broadcast and ``df`` is not shuffled at all, many meet it in a shuffle join.
    """
    one = F.lit(1).cast("bigint")
    ranks = materialise(duplicate_ranks(df, columns, row_id, chunk), "duplicate-ranks")
    return df.join(ranks, row_id, "left").withColumns(
        {"dup_rank": F.coalesce("dup_rank", one), "dup_count": F.coalesce("dup_count", one)}
    )


def key_collisions(df: DataFrame, key: Sequence[str], distinct: str) -> DataFrame:
    """Groups sharing a business key: how many, how many extra rows, how many really differ.

    A group has more than one distinct value exactly when its minimum and maximum differ, so no
    distinct count is needed.
    """
    groups = df.groupBy(*key).agg(
        F.count("*").alias("c"),
        F.coalesce(F.min(distinct) != F.max(distinct), F.lit(False)).alias("differs"),
    )
    repeated = F.col("c") > 1
    return groups.agg(
        F.count_if(repeated).alias("business_key_groups_with_collision"),
        F.coalesce(F.sum(F.when(repeated, F.col("c") - 1)), F.lit(0)).alias(
            "business_key_extra_rows"
        ),
        F.count_if(repeated & F.col("differs")).alias("collision_groups_with_distinct_requests"),
    )
