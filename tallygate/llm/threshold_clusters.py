"""Exact integer k-means whose assignments use the threshold algorithm on sorted centroid lists.

For each dimension the centroids are sorted by their component.  A vector starts at its own value
in every list and walks outward, one entry a dimension and step, to the nearer of the two next
entries.  A centroid met for the first time gets its exact distance.  In every dimension a
centroid not met yet is at least as far as the entry just read, so the sum of the squared frontier
distances bounds all of them; the walk ends when that sum is strictly larger than the best exact
distance.  Ties go to the smaller centroid number, hence the strict test.

A round is one pass over the written integer vectors.  Every task adds up its own vectors by
cluster, so a cluster with a third of all vectors is one partial row a task; what the driver sees
is the centroids (k rows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import arrow_schema, written
from tallygate.llm.vectors import integer_vectors, padded

#: Vector components times centroids handled at once inside a task.
WORK = 1 << 20


@dataclass(frozen=True)
class KMeans:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    #: seeds are the vectors whose sha256 of "<seed>:<vec_id>" is smallest
    seed: int = 3


class SortedLists:
    """The centroids, and each dimension's list of them in the order of its component."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        k, d = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable")
        # a guard on both ends of every list; its distance is never the smaller one
        self.values = np.take_along_axis(centroids, self.order, axis=0)
        self.k, self.d = k, d

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance of every row of ``x``."""
        step = max(1, WORK // max(1, self.k * self.d))
        parts = [self._walk(x[i : i + step]) for i in range(0, len(x), step)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, far = len(x), np.iinfo(np.int64).max
        dims = np.arange(self.d)
        exact = np.full((n, self.k), far)
        right = np.stack([np.searchsorted(self.values[:, j], x[:, j]) for j in dims], axis=1)
        left = right - 1
        active = np.arange(n)
        for _ in range(self.k):
            v, lo, hi = x[active], left[active], right[active]
            below = np.where(lo >= 0, v - self.values[np.maximum(lo, 0), dims], far)
            above = np.where(hi < self.k, self.values[np.minimum(hi, self.k - 1), dims] - v, far)
            down = below <= above
            frontier = np.where(down, below, above)
            met = self.order[np.where(down, lo, hi), dims]
            left[active] = lo - down
            right[active] = hi + ~down
            new = np.zeros((len(active), self.k), bool)
            new[np.arange(len(active))[:, None], met] = True
            new &= exact[active] == far
            r, c = np.nonzero(new)
            gap = v[r] - self.centroids[c]
            exact[active[r], c] = (gap * gap).sum(1)
            going = (frontier * frontier).sum(1) <= exact[active].min(1)
            active = active[going]
            if not len(active):
                break
        found = exact.argmin(1)
        return found, exact[np.arange(n), found]


def _assigned(centroids: np.ndarray) -> Callable:
    _, schema = arrow_schema("vec_id long, cluster int, distance long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            found, distance = lists.nearest(padded(batch.column("v"), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(found.astype(np.int32)), pa.array(distance)],
                schema=schema)

    return run


def _summed(centroids: np.ndarray) -> Callable:
    _, schema = arrow_schema("cluster int, n long, sums array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        n = np.zeros(lists.k, np.int64)
        sums = np.zeros((lists.k, lists.d), np.int64)
        for batch in batches:
            x = padded(batch.column("v"), lists.d)
            found, _ = lists.nearest(x)
            n += np.bincount(found, minlength=lists.k)
            for c in np.unique(found):
                sums[c] += x[found == c].sum(0)
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array(n[full]),
             pa.array(sums[full].tolist(), pa.list_(pa.int64()))], schema=schema)

    return run


def _seeds(vectors: DataFrame, how: KMeans) -> np.ndarray:
    """The first centroids; copies of a vec_id are told apart by their vectors."""
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (vectors.where("vec_id IS NOT NULL").select(digest.alias("h"), "v")
            .orderBy("h", "v").limit(how.clusters).collect())
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), how.dims)


def fit(vectors: DataFrame, how: KMeans) -> np.ndarray:
    """The centroids after all rounds; ``vectors`` (vec_id, v) should be a written table."""
    centroids = _seeds(vectors, how)
    if not len(centroids):
        return centroids
    for _ in range(how.rounds):
        partial = vectors.select("vec_id", "v").mapInArrow(
            _summed(centroids), "cluster int, n long, sums array<long>")
        total = partial.groupBy("cluster").agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.col("sums")[i]) for i in range(how.dims)]).alias("sums"))
        moved = centroids.copy()
        for row in total.collect():  # one row a centroid
            moved[row["cluster"]] = [s // row["n"] for s in row["sums"]]
        if (moved == centroids).all():  # further rounds would repeat this one
            break
        centroids = moved
    return centroids


def cluster(embeddings: DataFrame, how: KMeans | None = None) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256, centroid (array<long>).

    Runs one job a round.  Defined results: vectors that are null, of another length than
    ``dims``, or with a null or non-finite component are left out; repeated rows are each a
    vector; a null vec_id is clustered but never a seed (without any vec_id the result is empty);
    fewer vectors than clusters give as many centroids; an empty table gives an empty result;
    other columns are ignored.
    """
    how = how or KMeans()
    spark = embeddings.sparkSession
    vectors = written(
        integer_vectors(embeddings, ["vec_id"], "embedding", how.scale, how.dims), "vectors")
    centroids = fit(vectors, how)
    if not len(centroids):
        vectors = vectors.where("false")
        centroids = np.zeros((1, how.dims), np.int64)
    rows = written(vectors.mapInArrow(
        _assigned(centroids), "vec_id long, cluster int, distance long"), "clusters")
    # k rows: the sums of the clusters, with their centroids
    sums = {r["cluster"]: r["s"] for r in
            rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    described = []
    for c, x in enumerate(centroids.tolist()):
        digest = hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
        described.append((c, sums.get(c, 0), sum(sums.values()), digest, x))
    table = spark.createDataFrame(
        described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, "
        "centroid array<long>")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
        "centroid")
