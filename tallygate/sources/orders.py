"""Orders of report tables: stated once, with the place of NULLs, and applied by every sink.

A ``Report`` is a table and its order.  ``report`` looks the order up by the table's name; a table
without an entry is ordered by its columns from left to right, NULLs first.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sort terms of the report tables that are not in column order.
ORDERS: dict[str, tuple[str, ...]] = {
    "wait_percentiles": ("is_total DESC", "company ASC NULLS FIRST"),
    "metrics": ("metric", "grain", "dimensions"),
    "incentive_cells": ("list DESC", "rank ASC NULLS LAST", "pu_zone_id", "dow", "hour"),
}


class Report(NamedTuple):
    frame: DataFrame
    order: tuple[str, ...]

    def ordered(self) -> DataFrame:
        """The rows in order.  Reports are bounded by dimensions, so their sort is small."""
        return self.frame.orderBy(*[sort_term(t) for t in self.order])


def sort_term(term: str) -> Column:
    """``name [ASC|DESC] [NULLS FIRST|LAST]``; NULLs come first unless the term says otherwise."""
    name, *rest = term.split()
    words = [w.upper() for w in rest]
    descending, last = "DESC" in words, "LAST" in words
    if set(words) - {"ASC", "DESC", "NULLS", "FIRST", "LAST"}:
        raise ValueError(f"not a sort term: {term}")
    c = F.col(f"`{name}`")
    if descending:
        return c.desc_nulls_last() if last else c.desc_nulls_first()
    return c.asc_nulls_last() if last else c.asc_nulls_first()


def report(name: str, frame: DataFrame, order: Sequence[str] | None = None) -> Report:
    return Report(frame, tuple(order or ORDERS.get(name) or frame.columns))
