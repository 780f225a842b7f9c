"""Vector bin packing of examples into training sequences, with the dot-product heuristic.

*Limits.*  A sequence holds at most so many tokens, segments (pieces of examples) and loss-bearing
tokens.  Each is a dimension of the bin; an example's demand is a vector.

*Heuristic.*  One sequence is open at a time.  Of the examples that fit, the one whose demand has
the largest dot product with what is left (both as shares of the limits) is placed.  When none
fits, the best one is cut so that the sequence is full; examples that must stay whole are not cut.
A sequence that cannot be filled, because another limit is reached or nothing is left, is cut back
to a power of two, the only other length that needs no padding; the rest goes back to the others.

*Spark.*  Examples are packed where they are read: tokens never move.  A task fills sequences from
a bounded pool of examples as it reads them, so hot sources and skewed sizes make no hot group, and
the number of sequences that are cut back is a few a task.  Ids of sequences carry the partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.byte_bpe import encoder
from tallygate.llm.common import arrow_schema, text_or_empty

#: Tokens of a pool: what a task holds before it fills sequences.
POOL_TOKENS = 1 << 20
#: Pieces a batch of the result holds.
BATCH = 8192

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long, ids array<int>")


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024
    #: whether an example may be cut into several pieces
    cut: bool = True


class Example:
    """Token ids, which of them bear loss, and the segments of one example."""

    __slots__ = ("key", "ids", "loss", "bearing", "segments")

    def __init__(self, key, ids: np.ndarray, loss: np.ndarray | None = None, segments: int = 1,
                 free: int = 0) -> None:
        """``loss`` flags each id; without it all ids but the last ``free`` bear loss."""
        self.key, self.ids, self.segments = key, ids, segments
        self.bearing = len(ids) - free
        self.loss = None if loss is None else np.concatenate(([0], np.cumsum(loss)))

    def loss_between(self, a: int, b: int) -> int:
        if self.loss is None:
            return min(b, self.bearing) - min(a, self.bearing)
        return int(self.loss[b] - self.loss[a])

    def demand(self, a: int, b: int) -> tuple[int, int, int]:
        return b - a, self.segments, self.loss_between(a, b)

    def longest(self, a: int, b: int, tokens: int, loss: int) -> int:
        """End of the longest piece from ``a`` within so many tokens and loss-bearing tokens."""
        if self.loss is None:
            end = b if self.loss_between(a, b) <= loss else a + loss
        else:
            end = int(np.searchsorted(self.loss, self.loss[a] + loss, side="right")) - 1
        return min(b, a + tokens, max(a, end))


Piece = tuple[Example, int, int]


class Pool:
    """Pieces that wait for a place, equal demands together."""

    def __init__(self) -> None:
        self.place: dict[tuple[int, int, int], int] = {}
        self.tokens_of, self.segments_of, self.loss_of, self.counts = (
            np.zeros(64, np.int64) for _ in range(4))
        self.waiting: list[list[Piece]] = []
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        example, a, b = piece
        demand = example.demand(a, b)
        i = self.place.get(demand)
        if i is None:
            i = self.place[demand] = len(self.waiting)
            if i == len(self.counts):
                self.tokens_of, self.segments_of, self.loss_of, self.counts = (
                    np.concatenate((x, np.zeros_like(x)))
                    for x in (self.tokens_of, self.segments_of, self.loss_of, self.counts))
            self.tokens_of[i], self.segments_of[i], self.loss_of[i] = demand
            self.waiting.append([])
        self.waiting[i].append(piece)
        self.counts[i] += 1
        self.tokens += b - a

    def take(self, i: int, n: int) -> list[Piece]:
        out = self.waiting[i][-n:]
        del self.waiting[i][-n:]
        self.counts[i] -= n
        self.tokens -= sum(b - a for _, a, b in out)
        return out

    def tidy(self) -> None:
        """Forget demands nothing waits with, once they are most."""
        used = len(self.waiting)
        if used > 1024 and np.count_nonzero(self.counts[:used]) < used // 2:
            pieces = [p for group in self.waiting for p in group]
            self.__init__()
            for p in pieces:
                self.add(p)


def fill(pool: Pool, limits: Limits) -> tuple[list[Piece], int]:
    """Pieces of one sequence, and their tokens."""
    tokens, segments, loss = limits.tokens, limits.segments, limits.loss_tokens
    placed: list[Piece] = []
    while tokens > 0:
        used = len(pool.waiting)
        t, s, e = pool.tokens_of[:used], pool.segments_of[:used], pool.loss_of[:used]
        # dot products of demand and what is left, both as shares of the limits
        worth = (t * (tokens / limits.tokens**2) + s * (segments / limits.segments**2)
                 + e * (loss / limits.loss_tokens**2))
        waits = (pool.counts[:used] > 0) & (s <= segments)
        worth[~waits] = -1.0
        fitting = np.where((t <= tokens) & (e <= loss), worth, -1.0)
        i = int(fitting.argmax()) if used else -1
        if i >= 0 and fitting[i] >= 0:
            room = min(tokens // t[i], segments // s[i], loss // e[i] if e[i] else tokens)
            # equal examples: half of what fits, then weigh again
            n = int(min(room, pool.counts[i]) + 1) // 2
            tokens, segments = tokens - n * int(t[i]), segments - n * int(s[i])
            loss -= n * int(e[i])
            placed += pool.take(i, n)
            continue
        i = int(worth.argmax()) if used else -1
        if not limits.cut or i < 0 or worth[i] < 0:
            break
        example, a, b = pool.waiting[i][-1]
        end = example.longest(a, b, tokens, loss)
        if end == a:
            break
        pool.take(i, 1)
        placed.append((example, a, end))
        pool.add((example, end, b))
        used_tokens, used_segments, used_loss = example.demand(a, end)
        tokens, segments, loss = tokens - used_tokens, segments - used_segments, loss - used_loss
    return placed, limits.tokens - tokens


def _cut_back(pool: Pool, placed: list[Piece], total: int, wanted: int) -> list[Piece]:
    """The first ``wanted`` tokens of a sequence; the rest waits again."""
    while total > wanted:
        example, a, b = placed.pop()
        kept = max(0, b - a - (total - wanted))
        if kept:
            placed.append((example, a, a + kept))
        pool.add((example, a + kept, b))
        total -= b - a - kept
    return placed


def sequences(pool: Pool, limits: Limits, last: bool) -> Iterator[list[Piece]]:
    """Sequences of the pool's pieces; before the ``last`` call what does not fill one may stay."""
    while pool.tokens and (last or pool.tokens >= limits.tokens):
        pool.tidy()
        placed, total = fill(pool, limits)
        if total < limits.tokens and limits.cut:
            if not last and pool.tokens + total < POOL_TOKENS // 4:
                _cut_back(pool, placed, total, 0)
                return
            placed = _cut_back(pool, placed, total, 1 << (total.bit_length() - 1))
        yield placed


def pieces_of(example: Example, limits: Limits) -> Iterator[Piece]:
    """An example as pieces none of which alone is over a limit."""
    if example.segments > limits.segments:
        raise ValueError(f"{example.segments} segments in one example, limit {limits.segments}")
    a, n = 0, len(example.ids)
    while a < n:
        end = example.longest(a, n, limits.tokens, limits.loss_tokens)
        if end == a or (end < n and not limits.cut):
            raise ValueError(f"an example of {n} tokens is over a limit and may not be cut")
        yield example, a, end
        a = end


class _Rows:
    """Collects pieces as columns of the result."""

    def __init__(self, with_ids: bool) -> None:
        self.first = TaskContext.get().partitionId() << 33
        self.n, self.with_ids = 0, with_ids
        self.rows: list[tuple] = []

    def add(self, sequence: list[Piece]) -> None:
        offset = 0
        for example, a, b in sequence:
            ids = example.ids[a:b]
            self.rows.append((
                example.key, a, b - a, zlib.crc32(np.ascontiguousarray(ids, "<u4")),
                len(example.ids), self.first + self.n, offset, example.loss_between(a, b),
                ids.tolist() if self.with_ids else None))
            offset += b - a
        self.n += 1

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in schema]
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)],
            schema=schema)
        self.rows = []
        return out


def _packed(examples: Callable[[pa.RecordBatch], Iterator[Example]], limits: Limits,
            with_ids: bool) -> Callable:
    _, schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, out = Pool(), _Rows(with_ids)

        def drain(last: bool) -> Iterator[pa.RecordBatch]:
            for sequence in sequences(pool, limits, last):
                out.add(sequence)
                if len(out.rows) >= BATCH:
                    yield out.batch(schema)

        for batch in batches:
            for example in examples(batch):
                for piece in pieces_of(example, limits):
                    if piece[2] - piece[1] == limits.tokens:
                        out.add([piece])
                    else:
                        pool.add(piece)
                if pool.tokens >= POOL_TOKENS:
                    yield from drain(False)
                if len(out.rows) >= BATCH:
                    yield out.batch(schema)
        yield from drain(True)
        yield out.batch(schema)

    return run


# --------------------------------------------------------------------------------- documents


def pack_documents(docs: DataFrame, tokenizer_path: str, limits: Limits | None = None,
                   end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens, ids (null unless ``with_ids``).

    A document is its token ids and ``end_id``, which bears no loss.  No shuffle and no further
    job.  Defined results: a null or empty text is the end id alone; repeated rows, null or
    repeated ids are documents of their own; a very long text is many pieces; an empty table gives
    an empty result; other columns are ignored.
    """
    limits = limits or Limits()

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        found = encoder(tokenizer_path).encode(batch.column("text"))
        for key, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
            yield Example(key, np.append(ids, np.uint32(end_id)), free=1)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         text_or_empty().alias("text"))
    return source.mapInArrow(_packed(examples, limits, with_ids), PIECES)


def pack_examples(examples: DataFrame, limits: Limits | None = None,
                  with_ids: bool = True) -> DataFrame:
    """The same for encoded instruction examples: doc_id, ids (array<int>), loss (array<boolean>,
    null: every id bears loss), segments (null: 1).

    With ``limits.cut`` off every example stays whole.  Defined results: an example without ids
    has no piece; one that alone exceeds a limit and may not be cut stops the job; a null id list
    counts as empty, a null or missing flag in ``loss`` as false.
    """
    limits = limits or Limits()

    def read(batch: pa.RecordBatch) -> Iterator[Example]:
        for key, ids, loss, segments in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.array(ids or [], np.uint32)
            borne = np.ones(len(ids), bool)
            if loss is not None:
                borne[:] = [bool(x) for x in (loss + [False] * len(ids))[: len(ids)]]
            yield Example(key, ids, borne, 1 if segments is None else max(1, segments))

    source = examples.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<long>").alias("ids"),
        F.col("loss").cast("array<boolean>").alias("loss"),
        F.col("segments").cast("long").alias("segments"))
    return source.mapInArrow(_packed(read, limits, with_ids), PIECES)
