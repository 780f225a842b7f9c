"""Vectors as scaled integers: what the exact operators on embeddings start from."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import arrow_schema

#: Largest scaled component; squares and products of such components add up within 64 bits.
LARGEST = 1 << 27


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and joined values of a list column without nulls."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


def padded(column: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as an int64 matrix; shorter vectors end in zeros."""
    lengths, values = ragged(column)
    width = max(width, int(lengths.max()) if len(lengths) else 0)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def integer_vectors(
    df: DataFrame, columns: Sequence[str], vector: str, scale: int, dims: int | None = None
) -> DataFrame:
    """``columns`` (cast to long) and ``v`` = floor(scale * component) as array<int>.

    Left out: null vectors, vectors with a null or non-finite component, and, where ``dims`` is
    given, vectors of another length.  A component beyond 2^27 after scaling stops the job, since
    64-bit distances would not be exact.
    """
    ddl = ", ".join([*[f"{c} long" for c in columns], "v array<int>"])
    _, schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_vector")
            batch = batch.filter(pc.is_valid(column))
            column = batch.column("_vector").cast(pa.list_(pa.float64()))
            lengths, values = ragged(column)
            row = np.repeat(np.arange(len(lengths)), lengths)
            keep = np.bincount(row, ~np.isfinite(values), minlength=len(lengths)) == 0
            if dims is not None:
                keep &= lengths == dims
            scaled = np.floor(values[keep[row]] * float(scale))
            if len(scaled) and np.abs(scaled).max() > LARGEST:
                raise ValueError(f"component beyond {LARGEST} after scaling by {scale}")
            ends = np.concatenate(([0], np.cumsum(lengths[keep]))).astype(np.int32)
            v = pa.ListArray.from_arrays(pa.array(ends), pa.array(scaled.astype(np.int32)))
            rest = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [*[rest.column(c) for c in columns], v], schema=schema)

    source = df.select(*[F.col(c).cast("long").alias(c) for c in columns],
                       F.col(vector).cast("array<double>").alias("_vector"))
    return source.mapInArrow(run, ddl)
