"""Helpers shared by the operators: text buffers, hashes, written intermediates, row keys.

Row keys.  Identifiers may be null or repeated, so no operator relies on them to find a row again.
Where a result has to return to its row, the key is the content the result depends on (a hash of
the text, or of the text and the identifier); equal rows then get equal results.
"""

from __future__ import annotations

import ctypes
import gc
import inspect
import math
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygate.session import checkpoint_folder
from tallygate.sources.intermediates import delete
from tallygate.sources.writers import write_table

#: Text bytes handled at once inside a task; it bounds the memory of the vectorised code.
CHUNK_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and its workers: a whole group in one batch is held outside
#: the heap of an executor, several times while the batch grows.
BATCH_BYTES = 4 << 20
#: The folders of written tables.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: What ``kept`` holds in this process.
_kept: list[Callable] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    Runs a job.  Later stages start from files every executor sees, so a lost executor costs a
    re-read; the shuffles behind the table are no longer needed and are released.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    out = write_table(df, folder, partition_by)
    _folders[out] = folder
    release(spark)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete written tables: all that reads them has been written itself."""
    for table in tables:
        delete(table.sparkSession, [_folders.pop(table)])


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of plans nothing refers to any more.

    The first collection after a write frees the plan, only a second one its shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def kept(make: Callable) -> Callable:
    """Keep the last result of ``make`` in a Python worker, for its later tasks, until ``forget``."""
    cached = lru_cache(maxsize=1)(make)
    _kept.append(cached)
    return cached


def forget() -> None:
    """Let go of what operators keep in a Python worker: one used again may serve another next."""
    for cached in _kept:
        cached.cache_clear()


def give_back() -> None:
    """Return what is free in a Python worker to the system.

    Workers are used again by later stages, and freed arrays of a few MB otherwise stay with them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def make_room() -> None:
    """Before a task: what other operators, or tasks before, left in the worker is in the way."""
    forget()
    give_back()


def gives_back(run: Callable) -> Callable:
    """A task's function, or one of a group, that ends by giving back what it has freed.

    A worker waits for its next task with what the last one left, beside the executor's other worker.
    """
    if inspect.isgeneratorfunction(run):
        @wraps(run)
        def task(*args):
            try:
                yield from run(*args)
            finally:
                give_back()
    else:
        @wraps(run)
        def task(*args):
            try:
                return run(*args)
            finally:
                give_back()
    task.__signature__ = inspect.signature(run)  # Spark calls a group's function by its arguments
    return task


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside move Arrow batches of BATCH_BYTES at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def key_of(*columns: Column | str) -> Column:
    """Hash key of a row's content, with nulls told apart from empty values."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def partitions_for(rows: int, rows_per_partition: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / rows_per_partition))


# ----------------------------------------------------------------- bytes, words and hashes

_P = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_P), -1, 1 << 64))
    up = np.full(size, _P, np.uint64)
    down = np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one running polynomial over the whole buffer."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << max(20, int(len(buffer)).bit_length())
    up, down = _powers(size)
    running = np.empty(len(buffer) + 1, np.uint64)
    running[0] = 0
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=running[1:])
    return mix((running[ends] - running[starts]) * down[starts])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


class Words:
    """The words of several texts: byte spans, their text's index, and where each text begins."""

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray = SPACES,
                 fold: np.ndarray | None = LOWER) -> None:
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.buffer = joined if fold is None else fold[joined]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.starts, self.ends = runs(~separators[self.buffer])
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buffer, self.starts, self.ends)


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes; a longer text is a chunk of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def arrow_schema(fields: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType.fromDDL(fields)
    return schema, to_arrow_schema(schema)
