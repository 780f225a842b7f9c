"""Rule application: hits, quarantine/clean split, counts, trust lines and KPI sensitivity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.rules import Rule, eligible, flags, rejects, row_rules
from tallygate.settings import Settings


class TrustFloorError(RuntimeError):
    """Too few rows survived validation; carries the numbers behind the refusal."""

    def __init__(self, message: str, trust: dict, rule_counts: list[dict]):
        super().__init__(message)
        self.trust = trust
        self.rule_counts = rule_counts


class Split(NamedTuple):
    clean: DataFrame
    quarantine: DataFrame


def any_reject(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(r.hit) for r in rejects(rules)], F.lit(False))


def primary_rule(rules: Sequence[Rule]) -> Column:
    """First REJECT rule in file order that fired."""
    return F.coalesce(*[F.when(F.col(r.hit), F.lit(r.id)) for r in rejects(rules)])


def matched_rules(rules: Sequence[Rule]) -> Column:
    """Every REJECT rule that fired, in file order."""
    return F.array_compact(F.array(*[F.when(F.col(r.hit), F.lit(r.id)) for r in rejects(rules)]))


def with_hits(staged: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """One non-NULL boolean ``hit_<id>`` per rule, in a single projection."""
    run = {
        "month_start": settings.month_start,
        "month_end": settings.month_end,
        "unknown_zone_ids": settings.unknown_zone_ids,
    }
    return staged.withColumns({r.hit: r.fires(**run) for r in row_rules(rules)})


def split(checked: DataFrame, rules: Sequence[Rule]) -> Split:
    """Quarantine (any REJECT) and clean rows; FLAG columns travel on both sides."""
    hits = [r.hit for r in row_rules(rules)]
    carried = [c for c in checked.columns if c not in hits]
    flag_columns = [F.col(r.hit).alias(r.flag) for r in flags(rules)]
    rejected = any_reject(rules)
    quarantine = checked.where(rejected).select(
        primary_rule(rules).alias("rule_id"),
        matched_rules(rules).alias("reject_rules"),
        *carried,
        *flag_columns,
    )
    clean = checked.where(~rejected).select(
        *carried, *flag_columns, (F.col("dup_count") > 1).alias("flag_r05_survivor")
    )
    return Split(clean, quarantine)


def apply_rules(staged: DataFrame, rules: Sequence[Rule], settings: Settings) -> Split:
    return split(with_hits(staged, rules, settings), rules)


def _as_flags(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Checked rows with the columns both sides share, before any split."""
    return checked.withColumns(
        {
            "is_clean": ~any_reject(rules),
            "rule_id": primary_rule(rules),
            "n_rejects": F.size(matched_rules(rules)),
            **{r.flag: F.col(r.hit) for r in flags(rules)},
        }
    )


def rule_totals(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row holding every count of the run: a single pass, combined before the shuffle."""
    rows = _as_flags(checked, rules)
    clean = F.col("is_clean")
    counts = [F.count("*").alias("rows_in"), F.count_if(clean).alias("rows_clean")]
    for r in rejects(rules):
        counts.append(F.count_if(F.col("rule_id") == r.id).alias(f"primary_{r.id}"))
        counts.append(F.count_if(F.col(r.hit)).alias(f"matched_{r.id}"))
    for r in flags(rules):
        counts.append(F.count_if(clean & F.col(r.flag)).alias(f"clean_{r.id}"))
    counts.append(F.count_if(clean & (F.col("dup_count") > 1)).alias("survivors"))
    for family in ("wait", "dwell"):
        counts.append(F.count_if(clean & eligible(rules, family)).alias(f"{family}_rows"))
    return rows.agg(*counts)


def rule_counts(
    checked: DataFrame, rules: Sequence[Rule], totals: DataFrame | None = None
) -> DataFrame:
    """Per rule: rows, share of rows in, REJECT matches including overlaps, excluded families.

    ``totals`` is a ``rule_totals`` row already at hand; without it the checked rows are counted.
    """
    lines = []
    for r in row_rules(rules):
        reject = r in rejects(rules)
        lines.append(
            F.struct(
                F.lit(r.id).alias("rule_id"),
                F.lit(str(r.severity)).alias("severity"),
                F.lit(r.name).alias("name"),
                F.col(f"primary_{r.id}" if reject else f"clean_{r.id}").alias("rows"),
                (F.col(f"matched_{r.id}") if reject else F.lit(None).cast("bigint")).alias(
                    "rows_matching_incl_overlaps"
                ),
                F.lit(", ".join(r.excludes) or None).cast("string").alias("excludes"),
            )
        )
    lines.append(
        F.struct(
            F.lit("R05s").alias("rule_id"),
            F.lit("FLAG").alias("severity"),
            # fixed value: the line's name
            F.lit("survivor of an exact duplicate (kept copy)").alias("name"),
            F.col("survivors").alias("rows"),
            F.lit(None).cast("bigint").alias("rows_matching_incl_overlaps"),
            F.lit(None).cast("string").alias("excludes"),
        )
    )
    totals = rule_totals(checked, rules) if totals is None else totals
    share = F.try_divide(F.col("rows") * F.lit(100.0), F.col("rows_in"))
    return totals.select("rows_in", F.inline(F.array(*lines))).select(
        "rule_id",
        "severity",
        "name",
        "rows",
        F.coalesce(share, F.lit(0.0)).alias("pct_of_rows_in"),
        "rows_matching_incl_overlaps",
        "excludes",
    )


def trust_lines(
    checked: DataFrame, rules: Sequence[Rule], totals: DataFrame | None = None
) -> DataFrame:
    """How much data stands behind the numbers, all over rows in (0 when there are none)."""
    t = rule_totals(checked, rules) if totals is None else totals

    def share(column: str) -> Column:
        return F.coalesce(F.try_divide(F.col(column).cast("double"), F.col("rows_in")), F.lit(0.0))

    return t.select(
        "rows_in",
        F.col("rows_clean").alias("trusted_rows"),
        share("rows_clean").alias("trusted_row_share"),
        F.col("wait_rows").alias("wait_eligible_rows"),
        share("wait_rows").alias("wait_eligible_share"),
        "dwell_rows",
        share("dwell_rows").alias("dwell_coverage"),
    )


def reconciliation(clean: DataFrame, quarantine: DataFrame, staged: DataFrame) -> DataFrame:
    """rows in, clean, quarantined, and whether they add up."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("side"))

    sides = tagged(clean, "clean").unionByName(tagged(quarantine, "quarantined")).unionByName(
        tagged(staged, "in")
    )
    counted = sides.groupBy("side").count()
    of = {s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("count"))), F.lit(0)) for s in
          ("in", "clean", "quarantined")}
    return counted.agg(
        of["in"].alias("rows_in"),
        of["clean"].alias("rows_clean"),
        of["quarantined"].alias("rows_quarantined"),
    ).withColumn(
        "reconciles", F.col("rows_clean") + F.col("rows_quarantined") == F.col("rows_in")
    )


def trust_gate(
    checked: DataFrame,
    rules: Sequence[Rule],
    settings: Settings,
    totals: DataFrame | None = None,
) -> dict:
    """Raise ``TrustFloorError`` when the trusted share is below the floor (collects one row)."""
    trust = trust_lines(checked, rules, totals).first().asDict()
    if trust["trusted_row_share"] < settings.trust_floor:
        counts = [r.asDict() for r in rule_counts(checked, rules, totals).collect()]
        raise TrustFloorError(
            f"trusted-row share {trust['trusted_row_share']:.5f} is below the floor "
            f"{settings.trust_floor}: metrics are not published",
            trust,
            counts,
        )
    return trust


# ------------------------------------------------------------------ KPI under rule choices


def kpi_variants(
    checked: DataFrame,
    rules: Sequence[Rule],
    settings: Settings,
    wait_cap_rule: str = "R03",
    extra_flag: str = "flag_r14",
) -> DataFrame:
    """Late rate with one validation choice undone or added at a time.

    A row can belong to several variants.  Rows are first counted by the few booleans that decide
    membership, so the fan-out happens on that tiny table, not on trips.
    """
    rows = _as_flags(checked, rules)
    low, main, high = settings.late_thresholds
    late = {"low": low, "main": main, "high": high}
    ok = eligible(rules, "wait")
    only_cap = ~F.col("is_clean") & (F.col("rule_id") == wait_cap_rule) & (F.col("n_rejects") == 1)
    base = rows.where(F.col("is_clean") | only_cap)
    small = base.groupBy(
        F.col("is_clean"), ok.alias("ok"), F.col(extra_flag).alias("extra")
    ).agg(
        F.count("*").alias("n"),
        F.count("wait_minutes").alias("measured"),
        *[F.count_if(F.col("wait_minutes") > t).alias(f"late_{k}") for k, t in late.items()],
    )
    # The labels of the variants
    member = {
        "a headline: clean, excluding pre-arranged (R12)": F.col("is_clean") & F.col("ok"),
        "b if R03 rejects were kept": F.col("ok"),
        "c if pre-arranged (R12) rows were kept as measured": F.col("is_clean"),
        "d also excluding whole-minute requests (R14)": F.col("is_clean")
        & F.col("ok")
        & ~F.col("extra"),
    }
    variants = F.array_compact(F.array(*[F.when(p, F.lit(v)) for v, p in member.items()]))
    return (
        small.withColumn("variant", F.explode(variants))
        .groupBy("variant")
        .agg(
            F.sum("n").alias("n"),
            *[
                (F.try_divide(F.sum(f"late_{k}") * F.lit(100.0), F.sum("measured"))).alias(
                    f"late_rate_{k}_pct"
                )
                for k in late
            ],
        )
    )


def kpi_by_segment(clean: DataFrame, rules: Sequence[Rule], settings: Settings) -> DataFrame:
    """Late rate and wait coverage by company and accessibility request."""
    ok = eligible(rules, "wait")
    late = (F.col("wait_minutes") > settings.late_minutes).cast("int")
    return clean.groupBy(
        F.col("company_id").alias("company"), F.col("wav_request_flag").alias("wav_request")
    ).agg(
        F.count("*").alias("clean_rows"),
        F.count_if(ok).alias("rows_in_wait_metrics"),
        (F.avg(ok.cast("int")) * F.lit(100.0)).alias("wait_coverage_pct"),
        (F.avg(F.when(ok, late)) * F.lit(100.0)).alias("late_rate_pct"),
    )


def promotion_check(
    clean: DataFrame, rules: Sequence[Rule], settings: Settings, flag: str = "flag_r14"
) -> DataFrame:
    """Are flagged rows late so much more often that the flag should exclude them?"""
    rows = clean.where(eligible(rules, "wait"))
    late = (F.col("wait_minutes") > settings.late_minutes).cast("int")
    flagged = F.col(flag)
    measured = rows.agg(
        F.count_if(flagged).alias("whole_minute_rows"),
        F.round(F.count("*") / F.lit(60.0)).alias("expected_by_chance"),
        F.avg(F.when(flagged, late)).alias("late_rate_flagged"),
        F.avg(F.when(~flagged, late)).alias("late_rate_rest"),
    )
    ratio = F.try_divide(F.col("late_rate_flagged"), F.col("late_rate_rest"))
    return measured.select(
        "whole_minute_rows",
        "expected_by_chance",
        (F.col("whole_minute_rows") - F.col("expected_by_chance")).alias("excess_over_chance"),
        "late_rate_flagged",
        "late_rate_rest",
        ratio.alias("ratio"),
        F.when(ratio.isNull(), "cannot be computed")
        .when(F.round(ratio, 2) > settings.promotion_ratio, "above the bar")
        .otherwise("below the bar")
        .alias("verdict"),
    )
