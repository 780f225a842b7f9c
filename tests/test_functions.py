"""Quantiles, duplicates, hashing, samples and plans against brute force."""

import random
import statistics

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from trip_rows import minutes, trip

from tallygate.functions import quantiles
from tallygate.functions.derive import bands, dimension_value, linear_bin, log_bin
from tallygate.functions.hashing import digest_modulo, double_text, hash_sample, modulus_for
from tallygate.functions.quantiles import Also, Quantile, exact_quantiles, median, row_count
from tallygate.operators import duplicates
from tallygate.operators import sampling as smp
from tallygate.operators import validate as vr
from tallygate.operators.duplicates import key_collisions, mark_exact_duplicates
from tallygate.operators.profile import column_profile
from tallygate.operators.stage import stage
from tallygate.rules import DEFAULT_RULES
from tallygate.settings import Settings

SETTINGS = Settings(sample_modulus=10, append_per_rule=2)


def interpolated(values, q):
    ordered = sorted(values)
    at = q * (len(ordered) - 1)
    lo, hi = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
    return lo + (hi - lo) * (at - int(at))


def test_quantiles_match_brute_force_with_a_hot_group(spark):
    """A third of the rows in one group, negatives, ties, NULL keys and NULL values."""
    rnd = random.Random(7)
    rows = [("hot", rnd.choice([0.0, 1.5, -2.25])) for _ in range(1000)]
    rows += [(rnd.choice(["a", "b", None]), rnd.uniform(-1e6, 1e6)) for _ in range(1500)]
    rows += [("tiny", rnd.uniform(0, 1e-9)) for _ in range(300)]
    rows += [("none", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    levels = {"lo": 0.0, "p1": 0.01, "mid": 0.5, "p99": 0.99, "hi": 1.0}
    specs = [Quantile(a, "v", q) for a, q in levels.items()] + [median("pos", "v", "v > 0")]
    also = [row_count(), Also("top", "v", "max")]
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], specs, also).collect()}
    assert got["none"]["mid"] is None and got["none"]["n"] == 1 and got["none"]["top"] is None
    assert got["hot"]["n"] == 1000 and got["a"]["top"] == max(v for k, v in rows if k == "a")
    for key in ("hot", "a", "b", None, "tiny", "one"):
        values = [v for k, v in rows if k == key]
        for alias, q in levels.items():
            assert got[key][alias] == pytest.approx(interpolated(values, q), rel=1e-12), (key, q)
        positive = [v for v in values if v > 0]
        expected = statistics.median(positive) if positive else None
        assert got[key]["pos"] == (pytest.approx(expected) if positive else None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1,
                    max_size=60),
    q=st.floats(0, 1),
)
def test_quantile_property(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_quantiles(df, [], [Quantile("x", "v", q)]).first()["x"]
    assert got == pytest.approx(interpolated(values, q), rel=1e-9, abs=1e-30)


@pytest.mark.parametrize("kind", ["month", "tiny", "mixed"])
def test_full_slices_are_cut(spark, kind):
    """Values that share the first 26 bits: exact, and what is sorted stays small."""
    rnd = random.Random(5)
    values = {
        # microseconds of one month, as doubles
        "month": [1.7672256e15 + rnd.randrange(31 * 86_400_000_000) for _ in range(20_000)],
        "tiny": [1e-9 * (1 + rnd.random() * 1e-5) for _ in range(10_000)] + [5e-324, 0.0, -3e-310],
        "mixed": [-1e6 - rnd.random() for _ in range(6000)] + [1e6 + rnd.random() for _ in range(6000)]
                 + [float("inf"), float("-inf"), 7.0, 7.0],
    }[kind]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, v double")
    levels = {"p0": 0.0, "p1": 0.01, "p30": 0.3, "p50": 0.5, "p99": 0.99}
    specs = [Quantile(a, "v", q) for a, q in levels.items()]
    for row in exact_quantiles(df, ["k"], specs, [row_count()], sort_rows=100).collect():
        own = [v for i, v in enumerate(values) if i % 2 == row["k"]]
        assert row["n"] == len(own)
        for alias, q in levels.items():
            want = interpolated(own, q)
            assert row[alias] == pytest.approx(want, rel=1e-15, abs=0, nan_ok=True), (kind, alias)
    slices = df.withColumn("bin", F.expr(quantiles.BIN))
    assert slices.groupBy("bin").count().agg(F.max("count")).first()[0] > 100
    ends = slices.groupBy("bin").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    cuts = slices.join(ends, "bin").groupBy("bin", F.expr(quantiles.CUT)).count()
    assert cuts.agg(F.max("count")).first()[0] <= 100


def test_bins_are_ordered_like_values(spark):
    rnd = random.Random(9)
    values = sorted([s * 10.0 ** rnd.uniform(-320, 308) for s in (-1, 1) for _ in range(500)]
                    + [0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1.0, -1.0])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in df.coalesce(1).select(F.expr(quantiles.BIN)).collect()]
    assert found == sorted(found) and len(set(found)) > 900


def test_quantiles_read_the_input_once(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 17)
    specs = [Quantile("a", "v", 0.1), Quantile("b", "v", 0.9)]
    frame = exact_quantiles(df, [], specs, [row_count(), Also("top", "id", "max")])
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("Range (0, 1000") == 1 and "ReusedExchange" in final


def brute_duplicates(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r, []).append(i)
    return {i: (ids.index(i) + 1, len(ids)) for ids in groups.values() for i in ids}


@pytest.mark.parametrize("chunk", [4, 1 << 20])
def test_duplicate_ranks_with_a_hot_group(spark, chunk):
    """A third of all rows are copies of one row; ranks stay exact across small chunks."""
    rnd = random.Random(3)
    rows = [("same", None, 1.5)] * 70
    rows += [(rnd.choice("ab"), rnd.choice([1, None]), float(rnd.randint(0, 5)))
             for _ in range(100)]
    rows += [(None, 1, 0.0), (None, 1, -0.0), ("x", None, None), (None, None, None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "id bigint, a string, b int, c double"
    ).repartition(5)
    got = {
        r["id"]: (r["dup_rank"], r["dup_count"])
        for r in mark_exact_duplicates(df, ["a", "b", "c"], "id", chunk).collect()
    }
    assert got == brute_duplicates(rows)


def test_duplicates_with_equal_hashes(spark, monkeypatch):
    """Different rows that share a hash are told apart by their columns."""
    monkeypatch.setattr(duplicates, "_row_hash", lambda columns: F.lit(5).cast("bigint"))
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None])) for _ in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a string, b int")
    got = {r["id"]: (r["dup_rank"], r["dup_count"])
           for r in mark_exact_duplicates(df, ["a", "b"], "id", 16).collect()}
    assert got == brute_duplicates(rows)


def test_ranks_shuffle_no_compared_column(spark):
    """Once rows are verified, only ids, hashes and counts are read and moved."""
    rows = [(i, f"payload {i % 50}", i % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, wide string, b int")
    ranks = duplicates.duplicate_ranks(df, ["wide", "b"], "id")
    assert ranks.count() == 500
    text = ranks._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "wide" not in text and "row-hashes" in text


def test_key_collisions(spark):
    df = spark.createDataFrame(
        [("k", 1), ("k", 2), ("j", 5), ("j", 5), ("i", 1), (None, 1), (None, None)],
        "k string, v int",
    )
    row = key_collisions(df, ["k"], "v").first()
    assert tuple(row) == (3, 3, 1)


def test_double_text_matches_plain_digits(spark):
    values = [0.0, 3.0, 1e7, 1234567.5, 1e-3, 5e-4, 1e-4, 1e-5, 1.5e-6, 12345678.25, 1e15, 2.5e15,
              1e16, 1e20, -4e-4, -1e7, 0.1, 123456789012.125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(double_text(F.col("x"))).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT CAST(? AS DOUBLE)::VARCHAR", [v]).fetchone()[0] for v in values]
    assert got == want


@pytest.mark.parametrize("modulus", [1, 2, 10, 256, 400, 999_983])
def test_digest_modulo(spark, modulus):
    import hashlib

    words = [f"w{i}" for i in range(50)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(digest_modulo(F.md5("w"), modulus)).collect()]
    want = [int.from_bytes(hashlib.md5(w.encode()).digest(), "little") % modulus for w in words]
    assert got == want


def test_hash_sample_is_stable_and_proportional(make_trips):
    trips = make_trips([trip(pu_zone_id=i % 263 + 1, trip_miles=float(i)) for i in range(2000)])
    pick = lambda: sorted(
        r["trip_id"] for r in hash_sample(trips, SETTINGS.business_key, 10).collect()
    )
    assert pick() == pick() and 100 < len(pick()) < 300
    assert hash_sample(trips, SETTINGS.business_key, None).count() == 2000
    assert (modulus_for(None), modulus_for(0.1), modulus_for(5.0)) == (1, 10, 1)


def test_rare_rules_are_topped_up_in_order(make_trips):
    """Every rule that occurs is represented; a row taken for one rule is gone for the next."""
    plain = [trip(pu_zone_id=i % 263 + 1, trip_miles=float(i % 4 + 1)) for i in range(60)]
    both = trip(pickup_ts=trip()["pickup_ts"] + minutes(300), trip_miles=601.0, trip_time=1000,
                dropoff_ts=trip()["pickup_ts"] + minutes(320))
    rows = plain + [both, both | {"tips": 1.0}, both | {"tips": 2.0}, both | {"tips": 3.0},
                    both | {"tips": 4.0}]
    trips = make_trips(rows)
    checked = vr.with_hits(stage(trips), DEFAULT_RULES, SETTINGS)
    hits = smp.hits_of(checked, DEFAULT_RULES, SETTINGS)
    sides = vr.split(checked, DEFAULT_RULES)
    two_sided = smp.rule_hits(sides.clean, sides.quarantine, DEFAULT_RULES)
    pairs = sorted((r["trip_id"], r["rule_id"]) for r in hits.collect())
    assert pairs == sorted(map(tuple, two_sided.collect()))

    sample = hash_sample(trips, SETTINGS.business_key, SETTINGS.sample_modulus)
    in_sample = {r["trip_id"] for r in sample.collect()}
    by_rule = {}
    assert {r["trip_id"] for r in hits.where("in_sample").collect()} <= in_sample
    for t, r in pairs:
        by_rule.setdefault(r, set()).add(t)
    expected, taken = {}, set()
    for rule in [r.id for r in DEFAULT_RULES]:
        ids = by_rule.get(rule, set())
        if ids and not ids & in_sample:
            expected[rule] = sorted(ids - taken)[:2]
            taken.update(expected[rule])
    assert expected, "the fixture must leave at least one rule out of the sample"
    assert smp.top_up_ids(hits, DEFAULT_RULES, 2) == expected
    full = smp.rare_rule_sample(trips, hits, DEFAULT_RULES, SETTINGS)
    ids = [r["trip_id"] for r in full.collect()]
    assert sorted(ids) == sorted(in_sample | taken)
    with pytest.raises(smp.SampleSourceError):
        smp.require_full_run(trips, sample)


def test_bins_and_bands(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (12.0,), (200.0,)], "x double")
    rows = df.select(
        log_bin("x").alias("k"),
        linear_bin("x", 5).alias("b"),
        bands("x", [(1, "low"), (100, "mid")], "high").alias("band"),
    ).collect()
    assert [r["k"] for r in rows] == [-7, 0, 21, 46]
    assert [r["b"] for r in rows] == [0.0, 0.0, 10.0, 200.0]
    assert [r["band"] for r in rows] == ["low", "mid", "mid", "high"]
    text = spark.createDataFrame([("threshold_mm=0.5|borough=A",)], "d string")
    assert text.select(dimension_value("d", "borough")).first()[0] == "A"


def test_column_profile(spark):
    rows = [("a", 1.0), ("b", 2.0), ("b", None), (None, None), (None, 4.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "s string, x double")
    got = {r["column"]: r for r in column_profile(df, top=2).collect()}
    assert got["s"]["top_values"] == "NULL (3); b (2)" and got["s"]["n_distinct"] == 2
    assert got["s"]["null_pct"] == 50.0 and (got["x"]["min"], got["x"]["max"]) == ("1.0", "5.0")
    assert got["x"]["type"] == "double"
    # only `top` rows per task and column reach the ranking shuffle
    plan = column_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
