"""Exact interpolated quantiles with bounded state.

Spark's ``percentile`` keeps one value->count map per group in a single task, which grows with the
number of distinct values.  Here a group never has to fit anywhere:

1. count equal values:  ``(keys, value) -> c``.  Copies collapse before the shuffle and a hot group
   spreads over all tasks, because the value is part of the shuffle key;
2. sum those counts into slices ordered like the values and run a cumulative sum over the slices of
   each group, which tells in which slice every wanted rank lies;
3. keep only the values of those slices, and find the wanted ranks inside each.

*Radix selection.*  A double holds 64 bits.  The first slices are logarithmic, as fine as the sign,
the exponent and the first 14 bits of the fraction (also for the smallest values).  A wanted slice
with more than ``SORT_ROWS`` distinct values (timestamps of one month are all in a few) is cut by
the next 20 bits, with a second pass of counts; at most 2^18 doubles are left in a cut.  So whatever
the values, no task sorts more than ``SORT_ROWS`` of them, or the counts of ``CUTS`` cuts.

The answer is exact: slices only narrow the search.  All passes read the shuffle output of step 1,
not the input, and so do the plain sums, minima and maxima asked for beside the quantiles: the
input is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_E_FOLD = 16384
# Added to the logarithm of a size, so that every positive double's is positive.
LOG_SHIFT = 746.0
# Cuts of a full slice, and most distinct values of one slice that a single task sorts.
CUTS = 1 << 20
SORT_ROWS = 1 << 18
# Slice of the rows without a value; they weigh nothing.
NO_VALUE = -(2**62)


@dataclass(frozen=True)
class Quantile:
    """``alias`` = quantile ``q`` of ``value`` over the rows where ``where`` holds."""

    alias: str
    value: str
    q: float
    where: str | None = None

    @property
    def measure(self) -> tuple[str, str | None]:
        return self.value, self.where


@dataclass(frozen=True)
class Also:
    """``alias`` = sum, minimum or maximum of ``value`` over the group's rows."""

    alias: str
    value: str
    how: str = "sum"

    @property
    def partial(self) -> str:
        return f"also_{self.alias}"


def median(alias: str, value: str, where: str | None = None) -> Quantile:
    return Quantile(alias, value, 0.5, where)


def row_count(alias: str = "n") -> Also:
    return Also(alias, "1")


def rows_where(alias: str, predicate: str) -> Also:
    return Also(alias, f"CASE WHEN {predicate} THEN 1 ELSE 0 END")


def rows_known(alias: str, predicate: str) -> Also:
    """Rows where the predicate is not NULL: the denominator of its share."""
    return Also(alias, f"CASE WHEN ({predicate}) IS NULL THEN 0 ELSE 1 END")


def percent_of(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole)) * F.lit(100.0)


# Expressions are SQL text: a text is one call to the JVM, a chain of columns is dozens.

# log is monotone, so slices are ordered like the values; NaN last, as Spark sorts it
BIN = f"""CASE
    WHEN v IS NULL THEN {NO_VALUE}L
    WHEN isnan(v) THEN {2**62}L
    WHEN v = 0 THEN 0L
    WHEN abs(v) = double('inf') THEN bigint(signum(v)) * {2**61}L
    ELSE bigint(signum(v)) * (floor((ln(abs(v)) + {LOG_SHIFT}D) * {BINS_PER_E_FOLD}D) + 1L) END"""

# Place of a value among equal cuts between its slice's least and largest value.  Doubles within one
# logarithmic slice are evenly spaced, so equal cuts are the next bits.
CUT = f"coalesce(floor(try_divide(v - lo, hi - lo) * {CUTS - 1}D), 0L)"


def _names(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def value_counts(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[tuple[str, str | None]],
    also: Sequence[Also] = (),
) -> DataFrame:
    """``(keys, m, v) -> c``: how often each value of each measure occurs.

    The rows of measure 0 include those without a value (v NULL), and carry the partial results of
    ``also`` in the columns ``also_<alias>``.
    """
    columns = [
        f"double({value})" if where is None else f"CASE WHEN {where} THEN double({value}) END"
        for value, where in measures
    ]
    extra = [f"{x.value} AS `{x.partial}`" for x in also]
    if len(columns) == 1:
        stacked = df.selectExpr(*_names(keys), "0 AS m", f"{columns[0]} AS v", *extra)
    else:
        entries = ", ".join(f"struct({i} AS m, {v} AS v)" for i, v in enumerate(columns))
        stacked = df.selectExpr(*_names(keys), f"inline(array({entries}))", *extra)
    partial = [F.expr(f"{x.how}(CASE WHEN m = 0 THEN `{x.partial}` END) AS `{x.partial}`")
               for x in also]
    # -0.0 and 0.0 are one value
    return (
        stacked.where("m = 0 OR v IS NOT NULL")
        .withColumn("v", F.expr("v + 0D"))
        .groupBy(*keys, "m", "v")
        .agg(F.expr("count(v) AS c"), *partial)
    )


def roll_up(counts: DataFrame, keys: Sequence[str], also: Sequence[Also] = ()) -> DataFrame:
    """The same counts regrouped by other keys: what equal values of several groups add up to."""
    return counts.groupBy(*keys, "m", "v").agg(
        F.expr("sum(c) AS c"), *[F.expr(f"{x.how}(`{x.partial}`) AS `{x.partial}`") for x in also]
    )


def _rank(q: float, side: str) -> str:
    """The lower (floor) or upper (ceil) of the two ranks a quantile lies between."""
    return f"{side}({float(q)!r}D * double(n - 1))"


def _wanted(specs: Sequence[tuple[str, int, float]], before: str, size: str) -> str:
    """Whether a slice (``size`` rows after the first ``before``) holds a rank some quantile needs."""
    tests = [
        f"m = {m} AND {before} <= {_rank(q, side)} AND {_rank(q, side)} < {before} + {size}"
        for _, m, q in specs for side in ("floor", "ceil")
    ]
    return " OR ".join(f"({t})" for t in tests) or "false"


def _same(columns: Sequence[str]) -> Column:
    # null-safe throughout: a plain equality would push an IS NOT NULL filter into one side only,
    # and the reads of the counts could no longer share one shuffle
    return F.expr(" AND ".join(f"`{c}` <=> `t_{c}`" for c in columns))


def quantiles_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    specs: Sequence[tuple[str, int, float]],
    also: Sequence[Also] = (),
    sort_rows: int | None = None,
) -> DataFrame:
    """Quantiles ``(alias, m, q)`` per group of a ``(keys, m, v) -> c`` table.

    One row per group; a quantile whose measure has no value in the group is NULL.
    """
    sort_rows = SORT_ROWS if sort_rows is None else sort_rows
    keys = list(keys)
    group, place = _names([*keys, "m"]), _names([*keys, "m", "bin"])
    partials = [x.partial for x in also]
    totals = [f"all_{x.alias}" for x in also]
    part = ", ".join(group)
    binned = counts.selectExpr(*group, "v", "c", *_names(partials), f"{BIN} AS bin")
    per_bin = binned.groupBy(*keys, "m", "bin").agg(
        F.expr("sum(c) AS size"), F.expr("count(*) AS values"), F.expr("min(v) AS lo"),
        F.expr("max(v) AS hi"), *[F.expr(f"{x.how}(`{p}`) AS `{p}`")
                                  for x, p in zip(also, partials, strict=True)])
    located = per_bin.selectExpr(
        *place, "size", "values", "lo", "hi",
        f"sum(size) OVER (PARTITION BY {part} ORDER BY bin) - size AS before",
        f"sum(size) OVER (PARTITION BY {part}) AS n",
        *[f"{x.how}(`{p}`) OVER (PARTITION BY {part}) AS `{t}`"
          for x, p, t in zip(also, partials, totals, strict=True)])
    # slices that hold a wanted rank, and each group's slice without values
    wanted = located.where(f"{_wanted(specs, 'before', 'size')} OR bin = {NO_VALUE}L").selectExpr(
        *[f"`{c}` AS `t_{c}`" for c in [*keys, "m", "bin"]], "n", "before", "values", "lo", "hi",
        *_names(totals))
    # Slices of few values need no further pass.  Where there are no others, adaptive execution
    # sees that and drops the second branch; both read one shuffle of the counts.
    known = [*place, "v", "c", "n", "before", *_names(partials), *_names(totals)]
    few = f"values <= {sort_rows}"
    on = _same([*keys, "m", "bin"])
    narrow = binned.join(wanted.where(few), on).selectExpr(*known, "-1L AS cut")
    # spread by value: one slice may hold most rows
    full = binned.join(wanted.where(f"NOT ({few})"), on).selectExpr(
        *known, f"{CUT} AS cut").repartition(*keys, "m", "v")
    counted = full.groupBy(*keys, "m", "bin", "cut").agg(
        F.expr("sum(c) AS size"), F.expr("max(n) AS n"), F.expr("max(before) AS start"))
    over = f"OVER (PARTITION BY {', '.join(place)} ORDER BY cut)"
    placed = counted.selectExpr(
        *[f"`{c}` AS `t_{c}`" for c in [*keys, "bin", "cut"]], "m", "m AS t_m", "n", "size",
        f"start + sum(size) {over.replace('`m`', 'm')} - size AS at"
    ).where(_wanted(specs, "at", "size")).drop("m", "n", "size")
    cut = full.join(placed, _same([*keys, "m", "bin", "cut"]))
    inside = narrow.unionByName(cut.withColumn("before", F.col("at")).selectExpr(*known, "cut"))
    ranked = inside.selectExpr(
        *group, "v", "c", "n",
        f"before + sum(c) OVER (PARTITION BY {', '.join(place)}, cut ORDER BY v) - c AS before",
        # naming the partial as well keeps all reads of the counts alike, so they share a shuffle
        *[f"coalesce(`{t}`, `{p}`) AS `{t}`" for t, p in zip(totals, partials, strict=True)])
    ends = []
    for i, (_, m, q) in enumerate(specs):
        for side, rank in (("lo", _rank(q, "floor")), ("hi", _rank(q, "ceil"))):
            ends.append(f"max(CASE WHEN m = {m} AND before <= {rank} AND {rank} < before + c "
                        f"THEN v END) AS {side}_{i}")
        position = f"{float(q)!r}D * double(n - 1)"
        ends.append(f"max(CASE WHEN m = {m} THEN {position} - floor({position}) END) AS part_{i}")
    found = ranked.groupBy(*keys).agg(
        *[F.expr(e) for e in ends], *[F.expr(f"max(`{t}`) AS `{t}`") for t in totals])
    return found.selectExpr(
        *_names(keys),
        # without keys an empty input still has its one row
        *[(f"coalesce(`{t}`, 0)" if x.how == "sum" else f"`{t}`") + f" AS `{x.alias}`"
          for x, t in zip(also, totals, strict=True)],
        *[f"lo_{i} + (hi_{i} - lo_{i}) * part_{i} AS `{alias}`"
          for i, (alias, _, _) in enumerate(specs)])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Sequence[Quantile],
    also: Sequence[Also] = (),
    sort_rows: int | None = None,
) -> DataFrame:
    """Every requested quantile per group (linear interpolation between ranks), one row per group."""
    measures = list(dict.fromkeys(q.measure for q in quantiles))
    counts = value_counts(df, keys, measures, also)
    specs = [(q.alias, measures.index(q.measure), q.q) for q in quantiles]
    return quantiles_of_counts(counts, keys, specs, also, sort_rows)


def align(keys: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Put per-group tables side by side, one row per group.

    Every table holds at most one row per group and its own value columns.  Stacking them and
    taking the maximum per group joins them without a join: NULL keys meet NULL keys, and with no
    keys at all there is nothing to cross.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])
