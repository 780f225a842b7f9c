"""Column expressions over wall-clock timestamps, durations, bins and bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed seconds as DOUBLE, to the microsecond; negative when ``end`` precedes ``start``."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def wall_hour(ts: str | Column) -> Column:
    """Start of the wall-clock hour; date_trunc returns a zoned value, so cast it back."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def iso_weekday(ts: str | Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(ts) + F.lit(1)).cast("bigint")


def hour_number(ts: str | Column) -> Column:
    return F.hour(ts).cast("bigint")


def to_wall_clock(utc: str | Column, zone: str) -> Column:
    """A UTC NTZ value as the local wall clock of ``zone`` (daylight saving included)."""
    utc = F.col(utc) if isinstance(utc, str) else utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def log_bin(x: str | Column, per_decade: int = 20) -> Column:
    """Bin k covers [10^(k/per_decade), 10^((k+1)/per_decade)); callers filter to positives."""
    return F.floor(F.log10(x) * F.lit(float(per_decade))).cast("int")


def linear_bin(x: str | Column, width: float) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x / F.lit(float(width))).cast("double") * F.lit(float(width))


def bands(x: str | Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper edge lies above ``x``; NULL falls through to ``otherwise``."""
    x = F.col(x) if isinstance(x, str) else x
    head, *tail = edges
    start = F.when(x < head[0], head[1])
    return reduce(lambda acc, e: acc.when(x < e[0], e[1]), tail, start).otherwise(otherwise)


def share(predicate: Column) -> Column:
    """Share of rows where the predicate holds; rows where it is NULL are left out."""
    return F.avg(predicate.cast("int"))


def percent(predicate: Column) -> Column:
    return share(predicate) * F.lit(100.0)


def dimension_text(**parts: str | Column) -> Column:
    """``k=v|k=v`` dimension string of the long metric table."""
    pieces = []
    for i, (key, value) in enumerate(parts.items()):
        pieces.append(F.lit(("|" if i else "") + key + "="))
        pieces.append((F.col(value) if isinstance(value, str) else value).cast("string"))
    return F.concat(*pieces)


def dimension_value(dimensions: str | Column, key: str) -> Column:
    """Value of ``key`` in a ``k=v|k=v`` string."""
    dims = F.col(dimensions) if isinstance(dimensions, str) else dimensions
    return F.str_to_map(dims, F.lit("[|]"), F.lit("="))[key]
