"""Each rule on one crafted row, and how hits become quarantine, flags, counts and gates."""

from dataclasses import replace
from datetime import datetime

import pytest
from trip_rows import T0, minutes, trip

from tallygate.operators import validate as vr
from tallygate.operators.stage import stage
from tallygate.rules import DEFAULT_RULES, Rule, Severity, flags, parse_rules, rejects, row_rules
from tallygate.settings import Settings

SETTINGS = Settings()

CASES = {
    "R01": {"request_ts": T0 + minutes(9), "on_scene_ts": T0 + minutes(9)},
    "R02": {"dropoff_ts": T0 + minutes(8)},
    "R03": {
        "on_scene_ts": T0 + minutes(199),
        "pickup_ts": T0 + minutes(200),
        "dropoff_ts": T0 + minutes(224),
    },
    "R04": {
        "request_ts": datetime(2026, 8, 1, 0, 1),
        "on_scene_ts": datetime(2026, 8, 1, 0, 5),
        "pickup_ts": datetime(2026, 8, 1, 0, 7),
        "dropoff_ts": datetime(2026, 8, 1, 0, 31),
    },
    "R06": {"trip_miles": 60.0},
    "R07": {"trip_time": 1800},
    "R08": {"pu_zone_id": 265},
    "R09": {"on_scene_ts": None},
    "R10": {"trip_miles": 0.0},
    "R11": {"base_passenger_fare": -5.0},
    "R12": {"on_scene_ts": T0 - minutes(3)},
    "R13": {"on_scene_ts": T0 + minutes(8)},
    "R14": {"request_ts": T0.replace(second=0)},
}


def applied(make_trips, rows):
    checked = vr.with_hits(stage(make_trips(rows)), DEFAULT_RULES, SETTINGS)
    return checked, vr.split(checked, DEFAULT_RULES)


def test_every_row_rule_has_a_case():
    assert set(CASES) == {r.id for r in row_rules(DEFAULT_RULES)} - {"R05"}


def test_each_rule_fires_on_its_row_only(make_trips):
    """All crafted rows at once: row 0 is clean, row i + 1 was built for rule i."""
    ids = sorted(CASES)
    checked, sides = applied(make_trips, [trip()] + [trip(**CASES[i]) for i in ids])
    hit_columns = {r.id: r.hit for r in row_rules(DEFAULT_RULES)}
    fired = {
        row["trip_id"]: {i for i, c in hit_columns.items() if row[c]} for row in checked.collect()
    }
    assert fired[0] == set()
    # unavoidable company: arrival after pickup, an empty ride, a request on a whole minute
    extra = {"R01": {"R13"}, "R02": {"R07"}, "R04": {"R14"}}
    for n, rule_id in enumerate(ids):
        assert fired[n + 1] == {rule_id} | extra.get(rule_id, set()), rule_id
    rejected = {r.id for r in rejects(DEFAULT_RULES)}
    got = {(r["trip_id"], r["rule_id"]) for r in sides.quarantine.collect()}
    assert got == {(n + 1, i) for n, i in enumerate(ids) if i in rejected}


def test_exact_copy_is_rejected_and_survivor_marked(make_trips):
    _, sides = applied(make_trips, [trip(), trip(), trip(pu_zone_id=100)])
    assert [(r["rule_id"], r["trip_id"]) for r in sides.quarantine.collect()] == [("R05", 1)]
    kept = {r["trip_id"]: r["flag_r05_survivor"] for r in sides.clean.collect()}
    assert kept == {0: True, 2: False}


def test_riders_sharing_a_business_key_are_not_copies(make_trips):
    rider = trip(request_ts=T0 + minutes(1), base_passenger_fare=17.0)
    _, sides = applied(make_trips, [trip(), rider])
    assert sides.quarantine.count() == 0


def test_negative_wait_semantics(make_trips):
    """Explained by an early arrival: flagged.  Arrival unknown: neither rejected nor explained."""
    early = trip(request_ts=T0 + minutes(10))
    unknown = trip(request_ts=T0 + minutes(10), on_scene_ts=None)
    _, sides = applied(make_trips, [early, unknown])
    rows = {r["trip_id"]: r for r in sides.clean.collect()}
    assert rows[0]["flag_r12"] and not rows[1]["flag_r12"] and rows[1]["flag_r09"]


def test_zero_duration_never_divides(make_trips):
    _, sides = applied(make_trips, [trip(trip_time=0)])
    row = sides.clean.first()
    assert row["speed_mph"] is None and row["flag_r07"]


def test_first_reject_in_file_order_wins(make_trips):
    _, sides = applied(make_trips, [trip(**CASES["R03"], trip_miles=60.0)])
    row = sides.quarantine.first()
    assert (row["rule_id"], row["reject_rules"]) == ("R03", ["R03", "R06"])


def test_bad_dropoff_keeps_the_wait(make_trips):
    _, sides = applied(make_trips, [trip(**CASES["R02"])])
    row = sides.clean.first()
    assert (row["flag_r02"], row["wait_minutes"], row["trip_minutes"]) == (True, 8.0, 24.0)


def test_counts_reconcile_and_trust_lines(make_trips):
    rows = [trip(pu_zone_id=i % 263 + 1) for i in range(20)] + [trip(**c) for c in CASES.values()]
    checked, sides = applied(make_trips, rows)
    kept = vr.reconciliation(sides.clean, sides.quarantine, stage(make_trips(rows))).first()
    assert kept["reconciles"] and kept["rows_in"] == len(rows)
    counts = {r["rule_id"]: r for r in vr.rule_counts(checked, DEFAULT_RULES).collect()}
    assert counts["R06"]["rows"] == 1 and counts["R06"]["rows_matching_incl_overlaps"] == 1
    assert counts["R08"]["rows"] == 1 and counts["R08"]["excludes"] == "zone"
    # R14's own row; R04's row is on a whole minute too, but quarantined
    assert counts["R14"]["rows"] == 1
    assert counts["R05s"]["rows"] == 0
    trust = vr.trust_lines(checked, DEFAULT_RULES).first()
    assert trust["rows_in"] == 33 and trust["trusted_rows"] == 29
    assert trust["wait_eligible_rows"] == 28 and trust["dwell_rows"] == 27


def test_trust_of_nothing_is_zero(make_trips):
    checked, _ = applied(make_trips, [])
    trust = vr.trust_lines(checked, DEFAULT_RULES).first()
    assert trust["rows_in"] == 0 and trust["trusted_row_share"] == 0.0


def test_trust_floor_refuses(make_trips):
    checked, _ = applied(make_trips, [trip(), trip(**CASES["R03"])])
    with pytest.raises(vr.TrustFloorError) as refusal:
        vr.trust_gate(checked, DEFAULT_RULES, SETTINGS)
    assert refusal.value.trust["trusted_row_share"] == 0.5
    assert {c["rule_id"] for c in refusal.value.rule_counts} >= {"R03", "R05s"}
    relaxed = replace(SETTINGS, trust_floor=0.5)
    assert vr.trust_gate(checked, DEFAULT_RULES, relaxed)["trusted_rows"] == 1


def test_promotion_check_without_a_rest_is_undefined(make_trips):
    whole = trip(**CASES["R14"])
    _, sides = applied(make_trips, [whole])
    row = vr.promotion_check(sides.clean, DEFAULT_RULES, SETTINGS).first()
    assert row["ratio"] is None and row["verdict"] == "cannot be computed"


def test_rules_from_mappings():
    parsed = parse_rules(
        [
            {"id": "X1", "name": "far", "severity": "REJECT", "when": "trip_miles > {far}",
             "params": {"far": 10}},
            {"id": "X2", "name": "zone", "severity": "FLAG", "when": "pu_zone_id IN {ids}",
             "params": {"ids": [1, 2]}, "excludes": ["zone"]},
        ]
    )
    assert parsed[0].predicate() == "trip_miles > 10"
    assert parsed[1].predicate() == "pu_zone_id IN (1, 2)"
    assert [r.id for r in flags(parsed)] == ["X2"]
    with pytest.raises(ValueError):
        parse_rules([{"id": "X", "name": "a", "severity": "FLAG"}] * 2)
    with pytest.raises(ValueError):
        parse_rules([{"id": "X", "name": "a", "severity": "FIX"}])


def test_rule_names():
    rule = Rule("R09", "n", Severity.FLAG)
    assert (rule.hit, rule.flag) == ("hit_r09", "flag_r09")
