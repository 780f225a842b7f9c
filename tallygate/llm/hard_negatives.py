"""Hard negatives by inner product, with bounds carried along spanning trees of the anchors.

*Trees.*  Anchors are dealt, similar ones together, into trees of bounded size; each tree is the
minimum spanning tree of its anchors.  For a candidate c, parent p and child a,
``|<a, c> - <p, c>| <= |a - p| * |c|``: the parent's score, or its bounds where it was not scored,
bounds the child's score.  Only candidates whose bounds meet the child's window are scored.

*Windows.*  Looking for positives the window is everything from the anchor's lowest kept score
upward.  Looking for negatives, every positive has its own window of scores, whose lower end rises
with the lowest kept score once enough are found.

*Spark.*  Anchors are a stated set of queries against all rows.  They are taken in waves of a
proven size, which every task holds; a wave is two passes over the written candidates, and each
task keeps the best few per anchor (and positive), so no group is ever collected and a vector
shared by many rows is only rows of a scan.  Scores are exact integers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygate.llm.common import arrow_schema, partitions_for, written
from tallygate.llm.vectors import integer_vectors, padded
from tallygate.session import checkpoint_folder

RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
#: Integers up to here are exact as doubles, so sums of products may use them.
EXACT_DOUBLE = 1 << 53


@dataclass(frozen=True)
class Mining:
    anchor_step: int = 100
    positives: int = 5
    negatives: int = 10
    #: a negative's score lies between these percents of the positive's
    low_percent: int = 30
    high_percent: int = 90
    scale: int = 256
    #: rows with a vec_id divisible by this get the next label (modulo ``labels``); None: none do
    shift_step: int | None = 7
    labels: int = 10
    #: anchors of a tree, and bounds of a wave: anchors, and bytes of their vectors
    tree_size: int = 128
    wave_anchors: int = 16_384
    wave_bytes: int = 32 << 20


def labelled_vectors(embeddings: DataFrame, how: Mining) -> DataFrame:
    """(vec_id, label, v) of the rows that take part."""
    label = F.col("label").cast("long")
    if how.shift_step:
        shifted = (label + 1) % F.lit(how.labels)
        label = F.when(F.col("vec_id") % how.shift_step == 0, shifted).otherwise(label)
    rows = embeddings.where("label IS NOT NULL AND vec_id IS NOT NULL").select(
        F.col("vec_id"), label.alias("label"), F.col("embedding"))
    return integer_vectors(rows, ["vec_id", "label"], "embedding", how.scale)


# --------------------------------------------------------------------------------------- trees


@dataclass
class Tree:
    """Anchors in an order in which parents come first."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(vectors: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Order, parent's place in that order (-1 for the root) and edge length of Prim's tree."""
    x = vectors.astype(float)
    order, parent, edge = [0], [-1], [0.0]
    length = np.sqrt(((x - x[0]) ** 2).sum(1))
    link = np.zeros(len(x), np.int64)
    length[0] = np.inf
    for _ in range(len(x) - 1):
        i = int(length.argmin())
        order.append(i)
        parent.append(int(link[i]))
        edge.append(float(length[i]))
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        nearer = d < length
        length = np.where(np.isinf(length), length, np.minimum(length, d))
        link[nearer] = len(order) - 1
        length[i] = np.inf
    return order, parent, edge


TREES = ("ids array<long>, labels array<long>, width int, vectors binary, parent array<int>, "
         "edge array<double>")


def _coded() -> Callable:
    """Adds the signs of fixed random projections: similar vectors have similar codes."""
    _, schema = arrow_schema("vec_id long, label long, v array<int>, code int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = padded(batch.column("v"))
            plane = np.random.default_rng(11).choice([-1.0, 1.0], (x.shape[1], 16))
            code = ((x @ plane > 0) * (1 << np.arange(16))).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(code.astype(np.int32))], schema=schema)

    return run


def _planted(size: int) -> Callable:
    _, schema = arrow_schema(TREES)

    def tree(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        x = padded(pa.array(vectors, pa.list_(pa.int32())))
        order, parent, edge = spanning_tree(x)
        row = [[ids[i] for i in order], [labels[i] for i in order], x.shape[1],
               x[order].astype("<i4").tobytes(), parent, edge]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("vec_id", "label", "v")]
            for row in zip(*columns, strict=True):
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                if len(held[0]) == size:
                    yield tree(*held)
                    held = ([], [], [])
        if held[0]:
            yield tree(*held)

    return run


def anchor_trees(rows: DataFrame, how: Mining) -> DataFrame:
    """Written trees of the anchors among ``rows``; equal anchors are one."""
    anchors = written(rows.where(F.col("vec_id") % how.anchor_step == 0).distinct(), "anchors")
    parts = partitions_for(anchors.count(), 64 * how.tree_size)
    coded = anchors.mapInArrow(_coded(), "vec_id long, label long, v array<int>, code int")
    dealt = coded.repartitionByRange(parts, "code", "vec_id").sortWithinPartitions("code", "vec_id")
    return written(dealt.mapInArrow(_planted(how.tree_size), TREES), "anchor-trees")


def waves(trees: DataFrame, how: Mining) -> Iterator[list[Tree]]:
    """Trees in groups of a bounded size, streamed; the driver holds one group."""
    held: list[Tree] = []
    anchors = size = 0
    for row in trees.toLocalIterator():
        vectors = np.frombuffer(row["vectors"], "<i4").reshape(len(row["ids"]), row["width"])
        if held and (anchors + len(row["ids"]) > how.wave_anchors
                     or size + vectors.nbytes > how.wave_bytes):
            yield held
            held, anchors, size = [], 0, 0
        held.append(Tree(np.array(row["ids"], np.int64), np.array(row["labels"], np.int64),
                         vectors, np.array(row["parent"]), np.array(row["edge"])))
        anchors += len(row["ids"])
        size += vectors.nbytes
    if held:
        yield held


# ------------------------------------------------------------------------------------- scanning


class Best:
    """The first ``size`` candidates of one anchor, higher scores and then smaller ids first."""

    __slots__ = ("size", "ids", "scores")

    def __init__(self, size: int) -> None:
        self.size = size
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)

    @property
    def floor(self) -> int | None:
        """What a score must reach to be kept; None while everything is."""
        return int(self.scores[-1]) if len(self.scores) == self.size else None

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.floor is not None:
            good = scores >= self.floor
            ids, scores = ids[good], scores[good]
        if not len(ids):
            return
        ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
        order = np.lexsort((ids, -scores))[: self.size]
        self.ids, self.scores = ids[order], scores[order]


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` with ``y`` (equal widths)."""
    reach = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0))
    if reach < EXACT_DOUBLE:
        return (x.astype(float) @ y.astype(float)).astype(np.int64)
    if reach >= 1 << 63:
        raise ValueError("scores may not fit 64 bits")
    return x @ y.astype(np.int64)


class Candidates:
    """A batch of rows, with norms and, for the float case, the matrix ready to multiply."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.labels, self.x = ids, labels, x
        self.f = x.astype(float)
        self.largest = int(np.abs(x).max(initial=0))
        # a little more than the norm, so that rounding never narrows a bound
        self.norms = np.sqrt((self.f * self.f).sum(1)) * (1 + 1e-9) + 1e-9

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        w = min(self.x.shape[1], len(anchor))
        if w * self.largest * int(np.abs(anchor).max(initial=0)) < EXACT_DOUBLE:
            part = self.f[:, :w] if len(rows) == len(self.f) else self.f[rows, :w]
            return (part @ anchor[:w].astype(float)).astype(np.int64)
        return dots(self.x[rows, :w], anchor[:w])


class PositiveSearch:
    """Best candidates of the anchor's own label."""

    def __init__(self, anchor_id: int, label: int, size: int) -> None:
        self.anchor_id, self.label = anchor_id, label
        self.best = Best(size)

    def wants(self, c: Candidates, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        wanted = (c.labels == self.label) & (c.ids != self.anchor_id)
        if self.best.floor is not None:
            wanted &= high >= self.best.floor
        return wanted

    def offer(self, c: Candidates, rows: np.ndarray, scores: np.ndarray) -> None:
        mine = (c.labels[rows] == self.label) & (c.ids[rows] != self.anchor_id)
        self.best.offer(c.ids[rows[mine]], scores[mine])

    def kept(self) -> Iterator[tuple[int, Best]]:
        yield 0, self.best


class NegativeSearch:
    """Best candidates of other labels within the score window of each positive."""

    def __init__(self, label: int, windows: list[tuple[int, int]], size: int) -> None:
        self.label = label
        self.windows = [(lo, hi, Best(size)) for lo, hi in windows]

    def wants(self, c: Candidates, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(c.ids), bool)
        for lo, hi, best in self.windows:
            if lo <= hi:
                floor = lo if best.floor is None else max(lo, best.floor)
                wanted |= (high >= floor) & (low <= hi)
        return wanted & (c.labels != self.label)

    def offer(self, c: Candidates, rows: np.ndarray, scores: np.ndarray) -> None:
        other = c.labels[rows] != self.label
        ids, scores = c.ids[rows[other]], scores[other]
        for lo, hi, best in self.windows:
            good = (scores >= lo) & (scores <= hi)
            if good.any():
                best.offer(ids[good], scores[good])

    def kept(self) -> Iterator[tuple[int, Best]]:
        for i, (_, _, best) in enumerate(self.windows):
            yield i, best


Search = PositiveSearch | NegativeSearch


def walk(tree: Tree, searches: list[Search | None], c: Candidates) -> int:
    """Offer every candidate that can matter to every anchor's search; how many were scored."""
    n, scored = len(c.ids), 0
    low = np.empty((len(tree.ids), n))
    high = np.empty((len(tree.ids), n))
    every = np.arange(n)
    for i, search in enumerate(searches):
        up = tree.parent[i]
        if up < 0:
            rows = every
        else:
            reach = tree.edge[i] * (1 + 1e-9) * c.norms + 1e-6
            np.subtract(low[up], reach, out=low[i])
            np.add(high[up], reach, out=high[i])
            if search is None:
                continue
            rows = np.flatnonzero(search.wants(c, low[i], high[i]))
        if len(rows):
            scores = c.scores(tree.vectors[i], rows)
            low[i, rows] = high[i, rows] = scores
            scored += len(rows)
            if search is not None:
                search.offer(c, rows, scores)
    return scored


def _scan(trees: list[Tree], searches: Callable[[Tree, int], list[Search | None]]) -> Callable:
    """A pass over candidates; emits what each search kept: (tree, anchor, part, id, score)."""
    _, schema = arrow_schema("tree int, anchor int, part int, vec_id long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [searches(tree, t) for t, tree in enumerate(trees)]
        for batch in batches:
            c = Candidates(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(),
                           padded(batch.column("v")))
            for tree, mine in zip(trees, own, strict=True):
                walk(tree, mine, c)
        for t, mine in enumerate(own):
            rows = [(i, part, best) for i, s in enumerate(mine) if s is not None
                    for part, best in s.kept() if len(best.ids)]
            if not rows:
                continue
            sizes = [len(best.ids) for _, _, best in rows]
            columns = [np.full(sum(sizes), t), np.repeat([i for i, _, _ in rows], sizes),
                       np.repeat([p for _, p, _ in rows], sizes),
                       np.concatenate([b.ids for _, _, b in rows]),
                       np.concatenate([b.scores for _, _, b in rows])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x).cast(f.type) for x, f in zip(columns, schema, strict=True)],
                schema=schema)

    return run


def _first(found: DataFrame, size: int) -> DataFrame:
    """The first ``size`` rows per anchor and part over all tasks, with their ``rank``."""
    order = Window.partitionBy("tree", "anchor", "part").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _mine_wave(rows: DataFrame, trees: list[Tree], how: Mining) -> DataFrame:
    fields = "tree int, anchor int, part int, vec_id long, score long"

    def positives(tree: Tree, _: int) -> list[Search | None]:
        return [PositiveSearch(int(i), int(x), how.positives)
                for i, x in zip(tree.ids, tree.labels, strict=True)]

    near = _first(rows.mapInArrow(_scan(trees, positives), fields), how.positives)
    # at most ``positives`` rows for each anchor of the wave
    table = near.select("tree", "anchor", "rank", "vec_id", "score").toArrow()
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for t, a, _, i, s in sorted(zip(*(c.to_pylist() for c in table.columns), strict=True)):
        found.setdefault((t, a), []).append((i, s))

    def window(score: int) -> tuple[int, int]:
        # low_percent * score <= 100 * negative <= high_percent * score
        return -(-how.low_percent * score // 100), how.high_percent * score // 100

    def negatives(tree: Tree, t: int) -> list[Search | None]:
        return [NegativeSearch(int(x), [window(s) for _, s in found[t, a]], how.negatives)
                if (t, a) in found else None for a, x in enumerate(tree.labels)]

    ranked = _first(rows.mapInArrow(_scan(trees, negatives), fields), how.negatives)
    known = [(t, a, p, int(trees[t].ids[a]), i, s)
             for (t, a), group in found.items() for p, (i, s) in enumerate(group)]
    names = rows.sparkSession.createDataFrame(
        known, "tree int, anchor int, part int, anchor_id long, positive_id long, "
        "positive_score long")
    return ranked.join(names, ["tree", "anchor", "part"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def mine(embeddings: DataFrame, how: Mining | None = None) -> DataFrame:
    """Per anchor and positive the first negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Runs two jobs a wave of anchors.  Defined results: rows with a null vec_id, label or vector, or
    with a null or non-finite component take no part; rows that share the anchor's vec_id are not
    its positives, other repeated rows each count; equal anchors are one; shorter vectors count as
    ending in zeros; ties go to the smaller vec_id; an anchor without positives, or a positive
    without negatives, has no row; an empty table gives an empty result; other columns are ignored.
    """
    how = how or Mining()
    spark = embeddings.sparkSession
    rows = written(labelled_vectors(embeddings, how), "labelled-vectors")
    folder = f"{checkpoint_folder(spark)}/llm/negatives-{uuid.uuid4().hex}"
    wrote = False
    for i, trees in enumerate(waves(anchor_trees(rows, how), how)):
        _mine_wave(rows, trees, how).write.parquet(f"{folder}/wave={i}")
        wrote = True
    if not wrote:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(f"{folder}/wave=*")
