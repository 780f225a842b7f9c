"""Exact Jaccard self-join of shingle sets by partitioning the universe of shingles.

Shingles are hashed into ``n`` segments.  Two sets whose Jaccard similarity is at least ``tau`` and
whose smaller size is ``s`` differ in at most H = floor(s (1 - tau) / tau) elements.  With
n = H + 1 + m segments at least m + 1 segments of the two sets are equal (pigeonhole); the content
of one segment is a signature, and sets that share one are candidates.

*Size bands.*  H depends on the size, so sizes fall into bands whose ratio is 1 / tau: a set is
indexed by the segments of its own band and of the band below, which covers every partner.

*Cost-based allocation.*  An empty segment tells nothing and would gather every small set, so it is
not indexed.  The slack m is the number of empty segments a set of that band rarely exceeds.  A pair
can only be missed when both sets exceed it, so those sets alone are also indexed by one-deletion
neighbourhoods: with floor(H / 2) + 1 segments one differs in at most one element, and the
signatures of a segment are its content and its content less any one element, empty ones included.
Bands in which that costs fewer signatures (small sets) use it in the first place.

*Linear candidates.*  Sets, not documents, are joined: copies share one node.  In a group with one
signature every node is first paired with the smallest (linear in the group).  What that leaves in
several components is compared further, but only across components, because a pair inside one is
linked already:

- in groups of at most ``GROUP`` rows, pair by pair, so pairs are linear in the rows;
- signatures of larger groups are skipped like empty segments, as far as the slack allows.  A pair
  is missed only if both sets have more skipped segments than that.  Such sets, joined by the
  signatures they share into clusters, are compared block by block inside tasks: each block pair
  counts common shingles through an inverted list and returns a spanning set of links, no pairs.

Every link is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import (
    Words, chunks, drop, gives_back, key_of, make_room, mix, small_batches, text_or_empty, texts_of,
    written,
)
from tallygate.llm.components import components


#: Rows of a signature's group up to which its nodes are paired, and sets of a block of a cluster.
GROUP = 16
BLOCK_SETS = 1024
#: Offset of the spare segments in a code, which also holds the band and the kind of signature.
_SPARE = 512


@dataclass(frozen=True)
class Similarity:
    """Sets of ``words``-word shingles; linked when 100 |A and B| >= percent |A or B|."""

    words: int = 5
    percent: int = 80


# ------------------------------------------------------------------------------- shingles


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (empty without words)."""
    w = Words(texts)
    h = w.hashes()
    n = len(h)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        factor = mix(np.array([k + 1], np.uint64))[0] | np.uint64(1)
        rolled[: n - k] += h[k:] * factor
    rolled = mix(rolled)
    out = []
    for i in range(len(texts)):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:  # fewer words: the whole sequence, told apart by its length
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(31) + h[k : k + 1])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _node(s: np.ndarray) -> int:
    """64-bit identity of a set."""
    total = np.add.reduce(mix(s + np.uint64(len(s))), dtype=np.uint64)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


# ------------------------------------------------------------------- bands and signatures


def differences(size: int, percent: int) -> int:
    """Most elements in which two linked sets differ when the smaller has ``size``."""
    return size * (100 - percent) // percent


@lru_cache(maxsize=4)
def _bands(percent: int, largest: int) -> list[int]:
    """Upper sizes of the bands; a set one band up is at most 1 / tau larger."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return tops


@dataclass(frozen=True)
class Scheme:
    band: int
    segments: int
    slack: int
    deletion: bool
    #: segments of the one-deletion form, for sets with more empty segments than the slack
    wide: int


@lru_cache(maxsize=100_000)
def _scheme(band: int, top: int, low: int, percent: int) -> Scheme:
    h = differences(top, percent)
    wide = h // 2 + 1
    if not h:
        return Scheme(band, 1, 0, False, 1)

    def empties(n: int) -> float:
        return n * math.exp(-low / n)

    slack = 0
    for _ in range(8):  # the slack adds segments, which adds empty ones
        e = empties(h + 1 + slack)
        slack = math.ceil(e + 4 * math.sqrt(e)) + (1 if h > 4 else 0)
    rare = min(1.0, empties(h + 1 + slack)) if slack == 0 else 0.0
    exact_cost = h + 1 + slack + rare * (top + wide)
    return Scheme(band, h + 1 + slack, slack, top + wide <= 1.5 * exact_cost, wide)


def _split(s: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per segment: number of elements and two independent sums of their hashes (order-free)."""
    where = ((mix(s ^ np.uint64(salt)) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    where = where.astype(np.int64)
    counts = np.bincount(where, minlength=n)
    sums = np.zeros(n, np.uint64)
    order = np.argsort(where, kind="stable")
    filled = np.flatnonzero(counts)
    at = np.concatenate(([0], np.cumsum(counts[filled])[:-1])).astype(np.int64)
    if len(filled):
        sums[filled] = np.add.reduceat(mix(s + np.uint64(77))[order], at)
    return where, counts, sums


def _sign(kind: int, band: int, segment: np.ndarray, sums: np.ndarray,
          counts: np.ndarray) -> np.ndarray:
    head = np.uint64((kind << 60) + (band << 40)) + segment.astype(np.uint64)
    return mix(mix(head) + sums * np.uint64(3) + counts.astype(np.uint64))


def _exact(s: np.ndarray, x: Scheme) -> tuple[np.ndarray, int]:
    _, counts, sums = _split(s, x.segments, 11 + x.band)
    full = np.flatnonzero(counts)
    return _sign(1, x.band, full, sums[full], counts[full]), x.segments - len(full)


def _one_deletion(s: np.ndarray, x: Scheme) -> np.ndarray:
    where, counts, sums = _split(s, x.wide, 1_000_003 + x.band)
    every = np.arange(x.wide)
    whole = _sign(2, x.band, every, sums, counts)
    less = _sign(2, x.band, where, sums[where] - mix(s + np.uint64(77)), counts[where] - 1)
    return np.concatenate((whole, less))


def coded_signatures(s: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """Signatures of a set under its own band and the band below, by code.

    A code holds the band, the kind, and how many of the signatures may be skipped.
    """
    size = len(s)
    if not size:
        return []
    tops = _bands(percent, 1 << max(10, size.bit_length()))
    own = int(np.searchsorted(tops, size))
    out = []
    for band in (own, own - 1) if own else (own,):
        low = tops[band - 1] + 1 if band else 1
        x = _scheme(band, tops[band], low, percent)
        code = 2 * band * 2 * _SPARE
        empty = x.slack + 1
        if not x.deletion:
            found, empty = _exact(s, x)
            spare = max(-1, min(_SPARE - 1, x.slack - empty))
            out.append((code + _SPARE + spare, found))
        if empty > x.slack:
            out.append((code + 2 * _SPARE + _SPARE, np.unique(_one_deletion(s, x))))
    return out


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of a set."""
    found = [x for _, x in coded_signatures(s, percent)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


# ------------------------------------------------------------------------------ the tasks


def _per_text(batches: Iterator[pa.RecordBatch], words: int):
    for batch in batches:
        texts = texts_of(batch.column("text"))
        for a, b in chunks(texts):
            yield batch.slice(a, b - a), shingle_sets(texts[a:b], words)


def _nodes(words: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _per_text(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    part.column("text_key"),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                ["doc_id", "text_key", "node", "n_shingles"],
            )

    return run


def _signed(how: Similarity):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _per_text(batches, how.words):
            distinct = {_node(s): s for s in sets if len(s)}
            found = [(node, code, x) for node, s in distinct.items()
                     for code, x in coded_signatures(s, how.percent)]
            if not found:
                continue
            sizes = [len(x) for *_, x in found]
            nodes = np.repeat(np.array([n for n, *_ in found], np.int64), sizes)
            codes = np.repeat(np.array([c for _, c, _ in found], np.int32), sizes)
            sigs = np.concatenate([x for *_, x in found]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs), pa.array(nodes), pa.array(codes)], ["sig", "node", "code"])

    return run


def _sets(words: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _per_text(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["node", "members"],
            )

    return run


def _similar(percent: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in (x.slice(a, 512) for x in batches for a in range(0, x.num_rows, 512)):
            keep = []
            pairs = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(),
                        strict=True)
            for x, y in pairs:
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n, m = len(a), len(b)
                if 100 * min(n, m) < percent * max(n, m):
                    keep.append(False)
                    continue
                at = np.searchsorted(b, a)
                at[at == m] = m - 1
                both = int(np.count_nonzero(b[at] == a))
                keep.append(100 * both >= percent * (n + m - both))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    return run


def _block_links(percent: int):
    """Links that span the components of two blocks of a cluster (or of one with itself)."""
    @gives_back
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        rows = rows.drop_duplicates("node")
        nodes, blocks = rows["node"].to_numpy(), rows["block"].to_numpy()
        sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
        sizes = np.array([len(s) for s in sets])
        parent: dict[int, int] = {r: r for r in rows["root"]}

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        roots = rows["root"].to_list()
        right = np.flatnonzero(blocks == j)
        every = np.concatenate([sets[k] for k in right]) if len(right) else np.empty(0, np.uint64)
        shingles, of = np.unique(every, return_inverse=True)
        owner = np.repeat(np.arange(len(right)), sizes[right])[np.argsort(of, kind="stable")]
        begin = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(shingles)))))
        out = []
        for x in np.flatnonzero(blocks == i):
            at = np.searchsorted(shingles, sets[x])
            inside = at < len(shingles)
            at = at[inside][shingles[at[inside]] == sets[x][inside]]
            if not len(at):
                continue
            both = np.bincount(np.concatenate([owner[begin[k] : begin[k + 1]] for k in at]),
                               minlength=len(right))
            near = 100 * both >= percent * (sizes[x] + sizes[right] - both)
            for y in right[near]:
                a, b = find(roots[x]), find(roots[y])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((int(nodes[x]), int(nodes[y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


# --------------------------------------------------------------------------------- the join


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        _similar(percent), "a long, b long"
    )


def _crossing(rows: DataFrame, roots: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of nodes with a common signature that lie in different components, written.

    ``rows`` holds (sig, node), ``known`` the pairs to leave out.  Groups inside one component, the
    usual fate of a large group of copies, leave by a pre-aggregated minimum and maximum before any
    pair is formed.
    """
    placed = rows.join(roots, "node", "left").select(
        "sig", "node", F.coalesce("root", "node").alias("root")
    )
    mixed = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where(
        "lo <> hi"
    ).select("sig")
    placed = written(placed.join(mixed, "sig", "left_semi"), "mixed")
    left = placed.select("sig", F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = placed.select("sig", F.col("node").alias("b"), F.col("root").alias("root_b"))
    pairs = left.join(right, "sig").where("root_a < root_b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    pairs = written(pairs.join(known, ["a", "b"], "left_anti"), "pairs")
    drop(placed)
    return pairs


def jaccard_components(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, root, text_key.  Runs jobs.

    root names the component (null without words), text_key the text.

    Defined results: a null or empty text, or one without words, has an empty set and is linked
    with nothing, so it is its own component; a text of fewer words than a shingle is one shingle.
    component_id is the smallest doc_id of the component; rows that repeat a doc_id or a text are
    in one component with what equals them; a null doc_id is never the smallest unless the whole
    component has none.  An empty table gives an empty result; other columns are ignored.
    """
    text = text_or_empty()
    source = docs.select("doc_id", text.alias("text"), key_of(text).alias("text_key"))
    # a row of a pair to verify holds two whole sets
    with small_batches(docs.sparkSession):
        nodes = written(
            source.mapInArrow(_nodes(how.words),
                              "doc_id long, text_key long, node long, n_shingles long"), "nodes",
        )
        roots = _roots(source, nodes, how)
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        "root", "text_key"
    )


def _clusters(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(cluster, node, root), written: sets with too many skipped signatures.

    ``rows`` holds (sig, node, code, size).  A set is in one cluster per band and kind.
    """
    spare = F.pmod("code", F.lit(2 * _SPARE)) - _SPARE
    dense = rows.groupBy("node", "code").agg(
        F.count_if(F.col("size") > GROUP).alias("skipped")).where(F.col("skipped") > spare)
    part = F.floor(F.col("code") / (2 * _SPARE))
    kept = rows.where(F.col("size") > GROUP).join(dense, ["node", "code"], "left_semi").select(
        "sig", "node", F.xxhash64("node", part).alias("v"))
    kept = written(kept.distinct(), "dense")
    low = kept.groupBy("sig").agg(F.min("v").alias("b"))
    grouped = components(kept.join(low, "sig").select(F.col("v").alias("a"), "b"))
    members = kept.select("node", "v").distinct().join(
        grouped.select(F.col("node").alias("v"), F.col("root").alias("cluster")), "v")
    members = written(members.join(roots, "node", "left").select(
        "cluster", "node", F.coalesce("root", "node").alias("root")), "clusters")
    drop(kept)
    return members


def _several(members: DataFrame) -> DataFrame:
    """(cluster, node, root, n) of the clusters in which roots differ."""
    several = members.groupBy("cluster").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")
    ).where("lo <> hi").select("cluster", "n")
    return members.join(several, "cluster")


def _cluster_links(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    blocks = F.ceil(F.col("n") / BLOCK_SETS)
    placed = clusters.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("cluster", F.least("block", "other").alias("i"),
                           F.greatest("block", "other").alias("j"), "block", "node", "root")
    return placed.join(sets, "node").groupBy("cluster", "i", "j").applyInPandas(
        _block_links(percent), "a long, b long")


def _roots(source: DataFrame, nodes: DataFrame, how: Similarity) -> DataFrame:
    """(node, root) of every set that is linked with another set."""
    signed = source.select("text").mapInArrow(_signed(how), "sig long, node long, code int")
    shared = written(_repeated(signed), "signatures")
    wanted = nodes.groupBy("node").agg(F.min("text_key").alias("text_key")).join(
        shared.select("node").distinct(), "node", "left_semi"
    ).select("text_key")
    # one text a node, so each set comes once and is not shuffled; copies go before the shuffle
    sets = written(
        source.select("text", "text_key").dropDuplicates(["text_key"])
        .join(wanted.distinct(), "text_key", "left_semi").select("text")
        .mapInArrow(_sets(how.words), "node long, members binary"), "sets",
    )
    first = shared.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    first = written(first.distinct(), "pairs")
    links = written(_verified(first, sets, how.percent), "links")
    roots = components(links)
    crossing = _crossing(shared.where(F.col("size") <= GROUP).select("sig", "node"), roots, first)
    clusters = _clusters(shared, roots)
    more = _verified(crossing, sets, how.percent).union(
        _cluster_links(_several(clusters), sets, how.percent))
    more = written(more, "links")
    drop(shared, sets, first, crossing, clusters)
    if not more.isEmpty():
        roots = components(links.union(more))
    drop(links, more)
    return roots


def _repeated(signed: DataFrame) -> DataFrame:
    """(sig, node, code, low, size) of the signatures that several nodes have.

    low is their smallest node, size the number of rows.
    """
    from pyspark.sql import Window

    group = Window.partitionBy("sig")
    return signed.select(
        "*", F.min("node").over(group).alias("low"), F.max("node").over(group).alias("hi"),
        F.count("*").over(group).alias("size"),
    ).where("low <> hi").select("sig", "node", "code", "low", "size")

