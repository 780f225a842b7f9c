"""Declarative validation rules.

A rule is a SQL predicate over the staged columns.  REJECT moves the row to quarantine; FLAG keeps
it and removes it from the metric families the rule names; ASSUME documents a reading of the data
and touches no row.  A predicate that evaluates to NULL does not fire.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from enum import StrEnum
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class Severity(StrEnum):
    REJECT = "REJECT"
    FLAG = "FLAG"
    ASSUME = "ASSUME"


@dataclass(frozen=True)
class Rule:
    id: str
    name: str
    severity: Severity
    when: str = ""
    params: dict[str, Any] = field(default_factory=dict)
    excludes: tuple[str, ...] = ()

    @property
    def hit(self) -> str:
        return f"hit_{self.id.lower()}"

    @property
    def flag(self) -> str:
        return f"flag_{self.id.lower()}"

    def predicate(self, **run_params: Any) -> str:
        """The rule's SQL text with its own and the run's parameters filled in."""
        values = {k: _literal(v) for k, v in {**self.params, **run_params}.items()}
        return self.when.format(**values)

    def fires(self, **run_params: Any) -> Column:
        return F.coalesce(F.expr(self.predicate(**run_params)), F.lit(False))


def _literal(value: Any) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    if isinstance(value, Iterable):
        return "(" + ", ".join(_literal(v) for v in value) + ")"
    return str(value)


# Rule ids, names, order, severities, predicates, thresholds and excluded families.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule(
        "R05",
        "exact duplicate row",
        Severity.REJECT,
        "dup_rank > 1",
    ),
    Rule(
        "R04",
        "pickup outside target month",
        Severity.REJECT,
        "pickup_ts < to_timestamp_ntz({month_start}) OR pickup_ts >= to_timestamp_ntz({month_end})",
    ),
    Rule(
        "R01",
        "pickup before request, not pre-arranged",
        Severity.REJECT,
        "wait_minutes < 0 AND NOT (on_scene_ts < request_ts)",
    ),
    Rule(
        "R03",
        "implausibly long wait",
        Severity.REJECT,
        "wait_minutes > {max_wait_minutes}",
        {"max_wait_minutes": 180},
    ),
    Rule(
        "R06",
        "implausible implied speed",
        Severity.REJECT,
        "speed_mph > {max_speed_mph}",
        {"max_speed_mph": 65},
    ),
    Rule(
        "R02",
        "dropoff not after pickup (timestamp defect)",
        Severity.FLAG,
        "dropoff_ts <= pickup_ts",
        excludes=("timestamp_duration",),
    ),
    Rule(
        "R07",
        "trip_time disagrees with timestamps",
        Severity.FLAG,
        "abs(duration_gap_seconds) > {max_gap_seconds}",
        {"max_gap_seconds": 120},
        excludes=("trip_duration",),
    ),
    Rule(
        "R08",
        "unknown pickup zone",
        Severity.FLAG,
        "pu_zone_id IN {unknown_zone_ids}",
        excludes=("zone",),
    ),
    Rule(
        "R09",
        "on_scene missing",
        Severity.FLAG,
        "on_scene_ts IS NULL",
        excludes=("dwell",),
    ),
    Rule(
        "R10",
        "zero miles with non-trivial duration",
        Severity.FLAG,
        "trip_miles = 0 AND trip_time > {min_trip_seconds}",
        {"min_trip_seconds": 60},
        excludes=("speed",),
    ),
    Rule(
        "R11",
        "negative pay or fare",
        Severity.FLAG,
        "driver_pay < 0 OR base_passenger_fare < 0",
        excludes=("pay",),
    ),
    Rule(
        "R12",
        "pre-arranged pickup (on_scene before request)",
        Severity.FLAG,
        "on_scene_ts < request_ts",
        excludes=("wait",),
    ),
    Rule(
        "R13",
        "dwell not captured (on_scene at or after pickup)",
        Severity.FLAG,
        "on_scene_ts >= pickup_ts",
        excludes=("dwell",),
    ),
    Rule(
        "R14",
        "request on a whole minute (possible reservation)",
        Severity.FLAG,
        "second(request_ts) = 0",
    ),
    Rule("A01", "wait is request to pickup", Severity.ASSUME),
    Rule("A02", "only completed trips", Severity.ASSUME),
    Rule("A03", "one weather point for the city", Severity.ASSUME),
)


def parse_rules(items: Sequence[dict[str, Any]]) -> tuple[Rule, ...]:
    """Rules from plain mappings (the parsed content of a YAML or JSON rule file)."""
    rules = tuple(
        Rule(
            id=item["id"],
            name=item["name"],
            severity=Severity(item["severity"]),
            when=item.get("when", ""),
            params=dict(item.get("params") or {}),
            excludes=tuple(item.get("excludes") or ()),
        )
        for item in items
    )
    ids = [r.id for r in rules]
    if len(ids) != len(set(ids)):
        raise ValueError("rule ids must be unique")
    return rules


def rejects(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.severity is Severity.REJECT]


def flags(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.severity is Severity.FLAG]


def row_rules(rules: Sequence[Rule]) -> list[Rule]:
    """Rules that act on rows, in file order."""
    return [r for r in rules if r.severity is not Severity.ASSUME]


def eligible(rules: Sequence[Rule], *families: str) -> Column:
    """May a clean row enter metrics of these families?  TRUE when no rule excludes them."""
    barred = [~F.col(r.flag) for r in flags(rules) if set(families) & set(r.excludes)]
    return reduce(lambda a, b: a & b, barred, F.lit(True)) if barred else F.lit(True)
