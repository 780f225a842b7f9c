"""A deterministic sample of the month in which every rule that occurs is represented."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygate.bindings import ROW_ID
from tallygate.functions.hashing import hash_sample, in_sample
from tallygate.rules import Rule, flags, rejects, row_rules
from tallygate.settings import Settings


class SampleSourceError(RuntimeError):
    """The staged rows are already a sample of the raw rows."""


def rule_hits(clean: DataFrame, quarantine: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(trip_id, rule_id)`` for every REJECT match and every FLAG, on both sides of the split."""
    flagged = [F.when(F.col(r.flag), F.lit(r.id)) for r in flags(rules)]

    def hits(side: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
        ids = F.array_compact(F.array(*flagged))
        return side.select(ROW_ID, F.explode(F.concat(*extra, ids)).alias("rule_id"))

    return hits(clean).unionByName(hits(quarantine, [F.col("reject_rules")]))


def hits_of(checked: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """The same relation straight from checked rows, and whether the hash sample has the row.

    Membership in the sample is a function of the row's own key, so it is computed beside the hits
    and needs no join.
    """
    ids = F.array_compact(F.array(*[F.when(F.col(r.hit), F.lit(r.id)) for r in row_rules(rules)]))
    marked = in_sample(checked, settings.business_key, settings.sample_modulus)
    return marked.select(ROW_ID, "in_sample", F.explode(ids).alias("rule_id"))


def month_and_sample_counts(hits: DataFrame) -> DataFrame:
    """Rows per rule in the month and among the sampled rows, in one aggregate."""
    return hits.groupBy("rule_id").agg(
        F.count("*").alias("month_rows"), F.count_if("in_sample").alias("sample_rows")
    )


def top_up_ids(hits: DataFrame, rules: Sequence[Rule], k: int) -> dict[str, list[int]]:
    """Ids to append per rule that occurs in the month but not in the hash sample.

    Rules are served in file order and a row taken for one rule is gone for the next.  A rule can
    lose at most k rows to each rule before it, so the k x rules lowest ids of every absent rule
    are enough to choose from: that bounded list (at most k x rules^2 numbers) is what the driver
    sees.
    """
    order = [r.id for r in row_rules(rules)]
    counts = month_and_sample_counts(hits).collect()  # one row per rule
    absent = [r["rule_id"] for r in counts if not r["sample_rows"]]
    if not absent:
        return {}
    lowest = Window.partitionBy("rule_id").orderBy(ROW_ID)
    candidates = (
        hits.where(F.col("rule_id").isin(absent))
        .withColumn("place", F.row_number().over(lowest))
        .where(F.col("place") <= k * len(order))
        .select("rule_id", ROW_ID)
    )
    by_rule: dict[str, list[int]] = {}
    for row in candidates.collect():
        by_rule.setdefault(row["rule_id"], []).append(row[ROW_ID])
    taken: set[int] = set()
    chosen: dict[str, list[int]] = {}
    for rule_id in order:
        if rule_id not in by_rule:
            continue
        free = [i for i in sorted(set(by_rule[rule_id])) if i not in taken][:k]
        chosen[rule_id] = free
        taken.update(free)
    return chosen


def require_full_run(raw: DataFrame, staged: DataFrame) -> None:
    """A sample is cut from a full run only."""
    n_raw, n_staged = raw.count(), staged.count()
    if n_raw != n_staged:
        raise SampleSourceError(f"staged rows are a sample: {n_staged} of {n_raw}")


def rare_rule_sample(
    raw: DataFrame, hits: DataFrame, rules: Sequence[Rule], settings: Settings
) -> DataFrame:
    """Hash sample of ``raw`` plus the top-up rows of rules it misses; ``appended_for`` tells why.

    ``hits`` comes from ``hits_of``.  Runs the jobs that find the top-up ids.
    """
    sample = hash_sample(raw, settings.business_key, settings.sample_modulus)
    appended = top_up_ids(hits, rules, settings.append_per_rule)
    reason = F.lit(None).cast("string")
    for rule_id, ids in appended.items():
        if ids:
            reason = F.when(F.col(ROW_ID).isin(ids), F.lit(rule_id)).otherwise(reason)
    picked = sample.withColumn("appended_for", F.lit(None).cast("string"))
    every_id = [i for ids in appended.values() for i in ids]
    if not every_id:
        return picked
    extra = raw.where(F.col(ROW_ID).isin(every_id)).withColumn("appended_for", reason)
    return picked.unionByName(extra)


def rule_rows_in_month_and_sample(
    month: DataFrame, sample_counts: DataFrame, rules: Sequence[Rule]
) -> DataFrame:
    """(rule_id, rows_in_month, rows_in_sample) for every rule, 0 where a side has none.

    ``month`` holds (rule_id, rows_in_month); ``sample_counts`` is the ``rule_counts`` table of the
    sample validated on its own, whose REJECT rules count matches including overlaps.
    """
    order = [r.id for r in row_rules(rules)]
    reject_ids = [r.id for r in rejects(rules)]
    n = F.when(
        F.col("rule_id").isin(reject_ids), F.col("rows_matching_incl_overlaps")
    ).otherwise(F.col("rows"))
    sample = sample_counts.where(F.col("rule_id").isin(order)).select(
        "rule_id", n.alias("rows_in_sample"))
    both = sample.join(month, "rule_id", "full")
    zero = F.lit(0).cast("bigint")
    return both.select("rule_id", F.coalesce("rows_in_month", zero).alias("rows_in_month"),
                       F.coalesce("rows_in_sample", zero).alias("rows_in_sample"))
