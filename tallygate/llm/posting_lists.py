"""Nearest neighbours by inner product over balanced posting lists.

*Measure.*  Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and queries a
zero there; Euclidean order is then the order of inner products.  Scores are inner products of the
original vectors in double precision.

*Lists.*  Centroids are fitted on a bounded sample; a list that holds more than ``balance`` times
its share of the sample is split.  Every vector is indexed: in its nearest list, and in further
lists whose centroid is at most ``replicate`` times as far (boundary vectors), up to ``copies``.

*Search.*  Centroids are searched through a nearest-neighbour graph held in memory (its size is the
number of lists).  A query reads every list whose centroid is at most ``probe`` times as far as its
nearest, and more while they hold fewer than ``least_postings``; no number of lists is set.

*Equal vectors* are one row that keeps the smallest ids, as many as any result needs, so a vector
with a third of all ids is neither a long list nor a repeated search.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.llm.common import written


@dataclass(frozen=True)
class Index:
    neighbours: int = 20
    query_step: int = 20
    #: bound of the vectors the centroids are fitted on
    sample: int = 20_000
    #: vectors of the sample a list needs at least, which bounds the number of lists
    least_sample: int = 16
    balance: float = 2.0
    replicate: float = 1.03
    copies: int = 4
    probe: float = 1.18
    #: postings a query reads at least, so small tables are searched whole
    least_postings: int = 2048
    degree: int = 24
    beam: int = 48
    #: rows of postings and of queries that meet in one group
    posting_rows: int = 32_768
    query_rows: int = 8_192


# ------------------------------------------------------------------------ centroids and graph


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0))


def fit_centroids(x: np.ndarray, lists: int, balance: float) -> np.ndarray:
    """k-means with splits of large clusters; deterministic for a given sample."""
    rng = np.random.default_rng(7)
    centers = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for round_ in range(10):
        nearest = np.concatenate([
            _distances(x[i : i + 4096], centers).argmin(1) for i in range(0, len(x), 4096)])
        sizes = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, x)
        full = sizes > 0
        centers = sums[full] / sizes[full, None]
        limit = max(2.0, balance * len(x) / lists)
        if round_ < 8:
            for c in np.flatnonzero(sizes[full] > limit):
                members = x[nearest == np.flatnonzero(full)[c]]
                far = members[_distances(members, centers[c : c + 1])[:, 0].argmax()]
                centers = np.vstack((centers, (far + centers[c]) / 2))
    return centers


class Graph:
    """Nearest-neighbour graph of the centroids with a best-first search for many points at once."""

    def __init__(self, centers: np.ndarray, degree: int, beam: int) -> None:
        self.centers, self.beam = centers, beam
        k = min(degree, len(centers) - 1)
        d = _distances(centers, centers)
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        # a ring through all centroids keeps the graph connected
        ring = np.roll(np.arange(len(centers)), 1)[:, None]
        self.links = np.hstack((near, ring)) if k else ring
        step = max(1, len(centers) // 16)
        self.entries = np.arange(0, len(centers), step)

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids found, nearest first, and their distances; ``width`` of them a point."""
        n, total = len(points), len(self.centers)
        width = min(max(width, self.beam), total)
        norms = (self.centers * self.centers).sum(1)
        own = (points * points).sum(1)
        seen = np.zeros((n, total), bool)
        best = np.full((n, width), np.inf)
        found = np.full((n, width), -1)
        expanded = np.zeros((n, width), bool)

        def offer(rows: np.ndarray, ids: np.ndarray) -> None:
            nonlocal best, found, expanded
            new = ~seen[rows[:, None], ids]
            seen[rows[:, None], ids] = True
            dots = np.einsum("ij,ikj->ik", points[rows], self.centers[ids])
            d = np.sqrt(np.maximum(own[rows, None] + norms[ids] - 2 * dots, 0))
            d[~new] = np.inf
            alld = np.hstack((best[rows], d))
            alli = np.hstack((found[rows], np.where(new, ids, -1)))
            alle = np.hstack((expanded[rows], np.zeros_like(new)))
            order = np.argsort(alld, axis=1, kind="stable")[:, :width]
            best[rows] = np.take_along_axis(alld, order, 1)
            found[rows] = np.take_along_axis(alli, order, 1)
            expanded[rows] = np.take_along_axis(alle, order, 1)

        rows = np.arange(n)
        offer(rows, np.tile(self.entries, (n, 1)))
        for _ in range(total):
            open_ = ~expanded[rows] & (found[rows] >= 0)
            rows = rows[open_.any(1)]
            if not len(rows):
                break
            at = (~expanded[rows] & (found[rows] >= 0)).argmax(1)
            expanded[rows, at] = True
            # repeated links of one point are offered once
            ids = self.links[found[rows, at]]
            offer(rows, ids)
        return found, best


def _within(graph: Graph, points: np.ndarray, ratio: float, most: int | None,
            sizes: np.ndarray | None = None, least: int = 0) -> list[np.ndarray]:
    """Lists whose centroid is at most ``ratio`` times as far as the nearest one.

    With ``sizes``, at least so many of the nearest that they hold ``least`` postings.
    """
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(points)
    pending = np.arange(len(points))
    width = graph.beam if most is None else most
    while len(pending):
        found, d = graph.nearest(points[pending], width)
        again = []
        for row, ids, dist in zip(pending, found, d, strict=True):
            ok = (dist <= ratio * dist[0] + 1e-12) & (ids >= 0)
            if sizes is not None:
                ok |= (np.cumsum(sizes[ids]) - sizes[ids] < least) & (ids >= 0)
            if most is None and ok.all() and len(ids) < len(graph.centers):
                again.append(row)  # the beam was too narrow for this ratio
            else:
                out[row] = ids[ok][:most]
        pending = np.array(again, np.int64)
        width = 4 * max(width, graph.beam)
    return out


# --------------------------------------------------------------------------------- the tasks


def _matrix(column: pa.Array | pd.Series, kind=np.float32) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _extended(x: np.ndarray, largest: float | None) -> np.ndarray:
    x = x.astype(np.float64)
    last = np.zeros(len(x)) if largest is None else np.sqrt(
        np.maximum(largest**2 - (x * x).sum(1), 0))
    return np.column_stack((x, last))


def _number(raw: bytes) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("vec_id").to_pylist()
        vectors = batch.column("embedding").to_pylist()
        # adding zero makes a negative zero positive, so equal vectors have equal bytes
        raw = [(np.array(v, np.float32) + np.float32(0)).tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(map(_number, raw), pa.int64()),
             pa.array(raw, pa.binary())], ["vec_id", "u", "vec"])


def _smallest(keep: int):
    """Per task and vector, its smallest distinct ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, bytes], set[int]] = {}
        for batch in batches:
            for i, u, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "u", "vec")),
                               strict=True):
                ids = heaps.setdefault((u, v), set())
                ids.add(i)
                if len(ids) > 4 * keep:
                    heaps[u, v] = set(heapq.nsmallest(keep, ids))
            if len(heaps) >= 50_000:
                yield _emit(heaps, keep)
                heaps = {}
        if heaps:
            yield _emit(heaps, keep)

    return run


def _emit(heaps: dict, keep: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([u for u, _ in heaps], pa.int64()), pa.array([v for _, v in heaps], pa.binary()),
         pa.array([heapq.nsmallest(keep, s) for s in heaps.values()], pa.list_(pa.int64()))],
        ["u", "vec", "ids"])


def _posted(shared, ratio: float, most: int | None, largest: float | None,
            sizes: np.ndarray | None = None, least: int = 0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x = _extended(_matrix(part.column("vec")), largest)
                found = _within(graph, x, ratio, most, sizes, least)
                yield pa.RecordBatch.from_arrays(
                    [part.column("u"), part.column("vec"),
                     pa.array(found, pa.list_(pa.int64()))], ["u", "vec", "lists"])

    return run


def _best(keep: int):
    """The best vectors of one shard for each query, over the lists the query reads."""
    def run(_: tuple, postings: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["q", "u", "score"]
        if postings.empty or queries.empty:
            return pd.DataFrame({"q": [], "u": [], "score": []}).astype(
                {"q": "int64", "u": "int64"})
        x = _matrix(postings["vec"]).astype(np.float64)
        q = _matrix(queries["vec"]).astype(np.float64)
        us = postings["u"].to_numpy(np.int64)
        order = np.argsort(postings["list"].to_numpy(np.int64), kind="stable")
        names, begin = np.unique(postings["list"].to_numpy(np.int64)[order], return_index=True)
        span = {int(n): order[a:b] for n, a, b in
                zip(names, begin, [*begin[1:], len(order)], strict=True)}
        out = []
        for i, (name, lists) in enumerate(zip(queries["u"], queries["lists"], strict=True)):
            parts = [span[k] for k in lists if k in span]
            if not parts:
                continue
            at = np.concatenate(parts)
            score = x[at] @ q[i]
            if len(at) > 4 * keep:  # replicas repeat a vector at most as often as lists do
                top = np.argpartition(-score, min(len(at) - 1, 4 * keep))[: 4 * keep]
                cut = score[top].min()
                at, score = at[score >= cut], score[score >= cut]
            by = np.lexsort((us[at], -score))
            seen: dict[int, float] = {}
            last = -np.inf
            for j in by:
                if len(seen) >= keep and score[j] < last:
                    break  # further vectors that tie with the last stay
                seen.setdefault(int(us[at[j]]), float(score[j]))
                last = score[j]
            out.extend((name, u, s) for u, s in seen.items())
        return pd.DataFrame(out, columns=columns).astype({"q": "int64", "u": "int64"})

    return run


# -------------------------------------------------------------------------------- the search


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that take part: an id, the common dimension, finite, not zero."""
    e = F.col("embedding").cast("array<float>")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.where(~odd & F.exists("embedding", lambda x: x != 0))
    common = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(
        F.desc("c"), "n").first()
    return rows.where(F.size("embedding") == (common["n"] if common else 0))


def search(vectors: DataFrame, how: Index = Index()) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors of every query (id divisible by the step).

    Runs jobs that fit and write the index.  Defined results: rows without an id, null or zero
    vectors, vectors with null or non-finite components or not of the most frequent dimension take
    no part; equal scores are ordered by vec_id; rows that repeat an id and a vector are one; a
    query never finds its own id; with fewer candidates than asked for all are returned; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    keep = how.neighbours + 1  # one of them may be the query itself
    packed = written(usable(vectors).mapInArrow(_packed, "vec_id long, u long, vec binary"), "vec")
    local = packed.mapInArrow(_smallest(keep), "u long, vec binary, ids array<long>")
    distinct = written(
        local.select("u", "vec", F.explode("ids").alias("id")).distinct()
        .select("u", "vec", "id", F.row_number().over(
            Window.partitionBy("u", "vec").orderBy("id")).alias("k"))
        .where(F.col("k") <= keep)
        .groupBy("u", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
    n = distinct.count()
    queries = packed.where(F.col("vec_id") % how.query_step == 0).select("vec_id", "u").distinct()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = distinct.orderBy(F.xxhash64("u")).limit(how.sample).select("vec").toArrow().to_pandas()
    largest = float(distinct.select("vec").mapInArrow(_norms, "norm double").agg(
        F.max("norm")).first()[0])
    x = _extended(_matrix(sample["vec"]), largest)
    lists = max(1, min(int(np.sqrt(n)), len(x) // how.least_sample))
    shared = spark.sparkContext.broadcast(
        Graph(fit_centroids(x, lists, how.balance), how.degree, how.beam))
    postings = written(
        distinct.select("u", "vec").mapInArrow(
            _posted(shared, how.replicate, how.copies, largest),
            "u long, vec binary, lists array<long>")
        .select("u", "vec", F.explode("lists").alias("list")), "postings")
    counts = {r["list"]: r["n"] for r in
              postings.groupBy("list").agg(F.count("*").alias("n")).collect()}  # one row a list
    sizes = np.array([counts.get(k, 0) for k in range(len(shared.value.centers))])
    shards = _shards(spark, shared.value, sizes, how)
    placed = postings.join(F.broadcast(shards), "list").select(
        "u", "vec", "list", (F.col("shard") + F.pmod(F.xxhash64("u"), F.col("parts")))
        .alias("shard"))
    asked = distinct.join(queries.select("u").distinct(), "u", "left_semi").select(
        "u", "vec").mapInArrow(
            _posted(shared, how.probe, None, None, sizes,
                    max(how.copies * keep, how.least_postings)),
            "u long, vec binary, lists array<long>")
    reads = asked.select("u", "vec", F.explode("lists").alias("list")).join(
        F.broadcast(shards), "list").select("u", "vec", "list", F.explode(F.sequence(
            F.col("shard"), F.col("shard") + F.col("parts") - 1)).alias("shard"))
    reads = reads.groupBy("shard", "u").agg(F.first("vec").alias("vec"),
                                            F.collect_list("list").alias("lists"))
    reads = written(reads, "reads")
    blocks = reads.groupBy("shard").agg(
        F.ceil(F.count("*") / how.query_rows).alias("blocks"))
    reads = reads.join(blocks, "shard").select(
        "shard", F.pmod(F.xxhash64("u"), F.col("blocks")).alias("block"), "u", "vec", "lists")
    placed = placed.join(blocks, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "u", "vec", "list")
    near = placed.groupBy("shard", "block").cogroup(reads.groupBy("shard", "block")).applyInPandas(
        _best(keep), "q long, u long, score double")
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    merged = near.groupBy("q", "u").agg(F.max("score").alias("score")).join(
        distinct.select("u", "ids"), "u")
    merged = merged.withColumn("k", F.row_number().over(by)).where(F.col("k") <= keep)
    found = merged.select("q", "score", F.explode("ids").alias("vec_id"))
    ranked = found.withColumn("k", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("k") <= keep)
    ranked = ranked.groupBy("q").agg(F.sort_array(F.collect_list(
        F.struct("k", "vec_id", "score"))).alias("found"))
    answers = queries.select(F.col("vec_id").alias("query_id"), F.col("u").alias("q")).join(
        ranked, "q")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1,
                     how.neighbours)
    return answers.select("query_id", F.posexplode(others).alias("k", "f")).select(
        "query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"),
        F.col("f.score").alias("score"))


def _norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("vec")).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((x * x).sum(1)))], ["norm"])


def _shards(spark: SparkSession, graph: Graph, sizes: np.ndarray, how: Index) -> DataFrame:
    """(list, shard, parts): neighbouring lists share a shard; a long list has several of its own."""
    centered = graph.centers - graph.centers.mean(0)
    axis = np.linalg.svd(centered, full_matrices=False)[2][0]
    rows, shard, size = [], 0, 0
    for k in np.argsort(centered @ axis, kind="stable"):
        n = int(sizes[k])
        if size and size + n > how.posting_rows:
            shard, size = shard + 1, 0
        parts = max(1, -(-n // how.posting_rows))
        rows.append((int(k), shard, parts))
        if parts > 1:
            shard, size = shard + parts, 0
        else:
            size += n
    return spark.createDataFrame(rows, "list long, shard long, parts long")
