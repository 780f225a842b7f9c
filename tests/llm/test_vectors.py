"""Exact clustering and hard negatives against brute force and their reference SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from tallygate.llm import hard_negatives, threshold_clusters
from tallygate.llm.hard_negatives import Mining
from tallygate.llm.oracle import ORACLE_SQL
from tallygate.llm.threshold_clusters import KMeans, SortedLists

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, cluster int, v string, score double"


@pytest.fixture
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 9, "x", 0.5) for r in rows], VECTORS)

    return make


def odd_rows(dims, n, seed=3):
    """Clustered vectors with copies, ties, repeated and null ids, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        x = centers[i % 6] + 0.2 * rng.normal(size=dims)
        x = np.round(x * 4) / 4 if i % 3 == 0 else x
        rows.append((i * 5, [float(v) for v in x.astype(np.float32)], int(rng.integers(0, 4))))
    rows += [(10_000 + i, rows[7][1], rows[7][2]) for i in range(40)]
    rows += [rows[11], rows[20], rows[20], (100, rows[3][1], 3), (None, rows[4][1], 1)]
    rows += [(20_000, None, 1), (20_001, [1.0] * (dims - 1) + [None], 1), (20_002, [], 1),
             (20_003, [math.nan] * dims, 2), (20_004, [math.inf] + [0.0] * (dims - 1), 2),
             (20_100, [1.0] * (dims + 1), 0), (20_006, [0.5] * dims, None), (20_200, [0.0] * dims, 2)]
    return rows


def scaled(x, scale):
    return [math.floor(scale * float(v)) for v in x]


def usable(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


# ---------------------------------------------------------------------------------- clustering


def brute_clusters(rows, how):
    kept = [(i, scaled(x, how.scale)) for i, x, _ in rows if usable(x) and len(x) == how.dims]
    seeds = sorted((hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest(), x)
                   for i, x in kept if i is not None)
    centroids = [x for _, x in seeds[: how.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k)
                    for k, c in enumerate(centroids)) for _, x in kept]

    if not centroids:
        return []
    for _ in range(how.rounds):
        found = assign()
        for k in range(len(centroids)):
            members = [x for (_, x), (_, c) in zip(kept, found, strict=True) if c == k]
            if members:
                centroids[k] = [sum(v) // len(members) for v in zip(*members, strict=True)]
    found = assign()
    inertia = {k: sum(d for d, c in found if c == k) for k in range(len(centroids))}
    return sorted(
        (-1 if i is None else i, c, d, inertia[c], sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for (i, _), (d, c) in zip(kept, found, strict=True))


def test_clusters_match_brute_force(make_vectors):
    rows = odd_rows(6, 120)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for how in (KMeans(dims=6), KMeans(clusters=40, rounds=3, dims=6), KMeans(dims=7, rounds=2)):
        found = threshold_clusters.cluster(make_vectors(rows), how).select(columns).collect()
        found = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found)
        assert found == brute_clusters(rows, how)
    for rows in ([], [(1, None, 1)], [(None, [0.5] * 6, 1)]):
        assert threshold_clusters.cluster(make_vectors(rows), KMeans(dims=6)).count() == 0


def test_clusters_match_sql(spark):
    found = threshold_clusters.cluster(spark.read.parquet(f"{SF}/embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = con.execute(ORACLE_SQL["op12_threshold_clusters"]).df()
    found = found.select(*expected.columns).toPandas()
    order = ["vec_id"]
    assert len(found) == 500
    assert found.sort_values(order).values.tolist() == expected.sort_values(order).values.tolist()


def test_walk_equals_all_distances():
    rng = np.random.default_rng(1)
    for k, d, spread in ((1, 3, 5), (8, 64, 300), (50, 2, 4), (30, 5, 1000)):
        centroids = rng.integers(-spread, spread, (k, d))
        x = rng.integers(-2 * spread, 2 * spread, (500, d))
        x[:50] = centroids[rng.integers(0, k, 50)]
        all_of = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
        found, distance = SortedLists(centroids).nearest(x)
        assert (found == all_of.argmin(1)).all() and (distance == all_of.min(1)).all()


def test_large_components_stop_the_job(make_vectors):
    with pytest.raises(Exception, match="component beyond"):
        threshold_clusters.cluster(make_vectors([(1, [1e30] * 6, 1)]), KMeans(dims=6)).collect()


# ------------------------------------------------------------------------------- hard negatives


def brute_negatives(rows, how):
    kept = []
    for i, x, label in rows:
        if i is not None and label is not None and usable(x):
            if how.shift_step and i % how.shift_step == 0:
                label = (label + 1) % how.labels
            kept.append((i, label, tuple(scaled(x, how.scale))))

    def score(a, b):
        return sum(p * q for p, q in zip(a, b, strict=False))

    out = []
    for i, label, x in sorted({r for r in kept if r[0] % how.anchor_step == 0}):
        own = sorted((-score(x, y), j) for j, other, y in kept if other == label and j != i)
        far = sorted((-score(x, y), j) for j, other, y in kept if other != label)
        for s, j in own[: how.positives]:
            inside = [(t, k) for t, k in far
                      if how.low_percent * -s <= 100 * -t <= how.high_percent * -s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(inside[: how.negatives])]
    return sorted(out)


def mined(df, how=None):
    return sorted(tuple(r) for r in hard_negatives.mine(df, how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score",
        "negative_score").collect())


def test_negatives_match_brute_force(make_vectors):
    rows = odd_rows(8, 300)
    df = make_vectors(rows)
    for how in (Mining(), Mining(anchor_step=10, tree_size=7, wave_anchors=40),
                Mining(anchor_step=25, scale=1, shift_step=None, positives=2, negatives=3)):
        found = mined(df, how)
        assert found and found == brute_negatives(rows, how)
    assert mined(make_vectors([])) == []
    assert mined(make_vectors([(100, [1.0], 1), (200, None, 1), (300, [1.0], None)])) == []


def test_negatives_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = sorted(con.execute(ORACLE_SQL["op13_hard_negatives"]).fetchall())
    assert mined(spark.read.parquet(f"{SF}/embeddings.parquet")) == expected and expected


def test_bounds_spare_scores():
    """Anchors close together: a child scores only what its parent's scores leave open."""
    rng = np.random.default_rng(2)
    anchors = rng.integers(-100, 100, (1, 16)) + rng.integers(-2, 3, (20, 16))
    order, parent, edge = hard_negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(20)) and all(p < i for i, p in enumerate(parent))
    tree = hard_negatives.Tree(np.arange(20), np.zeros(20, np.int64), anchors[order],
                               np.array(parent), np.array(edge))
    x = rng.integers(-100, 100, (2000, 16))
    c = hard_negatives.Candidates(np.arange(100, 2100), np.zeros(2000, np.int64), x)
    searches = [hard_negatives.PositiveSearch(i, 0, 5) for i in range(20)]
    first = hard_negatives.walk(tree, searches, c)
    second = hard_negatives.walk(tree, searches, hard_negatives.Candidates(c.ids + 5000, c.labels, x - 60))
    assert first <= 40_000 and second < 20_000
    both = np.vstack((x, x - 60))
    for i, s in enumerate(searches):
        assert s.best.scores.tolist() == np.sort(both @ tree.vectors[i])[::-1][:5].tolist()


def test_exact_products():
    x = np.array([[1 << 27, -(1 << 27)], [(1 << 27) - 1, 3]])
    y = np.array([(1 << 27) - 1, 1 << 26])
    expected = [sum(int(a) * int(b) for a, b in zip(r, y, strict=True)) for r in x]
    assert hard_negatives.dots(x, y).tolist() == expected
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.dots(np.full((1, 600), 1 << 27), np.full(600, 1 << 27))
