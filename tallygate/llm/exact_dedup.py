"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Tasks fold A-Z, hash every text, and write fingerprints in blocks; texts stay where they are.
2. Each block sends its sorted distinct fingerprints, Rice-coded, to the owners of hash ranges.
3. An owner merges the lists of its range and answers each block with a bitmap: bit i tells that
   the block's i-th fingerprint of that range also occurs in another block.
4. Blocks read their bitmaps; a fingerprint marked there, or seen twice in the block, is suspect.
5. Only suspects' texts are shuffled, grouped byte by byte (copies meet before the shuffle).

Defined results: a null text counts as empty; texts are equal when identical after lower-casing
A-Z; the row with the largest doc_id stays, a null doc_id counting as smaller than any other; of
several rows with that same doc_id and text all are marked kept (they cannot be told apart).  An
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm import rice
from tallygate.llm.common import partitions_for, texts_of, written

#: Rows of a block; it bounds what one block's task holds (a few MB).
BLOCK_ROWS = 1 << 16
#: Fingerprints an owner merges on average; the number of owners follows the number of rows.
OWNER_ROWS = 1 << 19

_PRINTS = "doc_id long, fp long, text_sha256 string, block string"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        yield batch, [t.lower() for t in texts_of(batch.column("text"))]


def _print(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, rows = TaskContext.get().partitionId(), 0
    for batch, texts in _folded(batches):
        blocks = [f"{task}-{(rows + i) // BLOCK_ROWS}" for i in range(len(texts))]
        rows += len(texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(map(_print, texts), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.array(blocks, pa.string()),
            ],
            ["doc_id", "fp", "text_sha256", "block"],
        )


def _owned(fps: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints as unsigned numbers, and where each owner's range begins."""
    values = np.unique(fps.view(np.uint64))
    edges = np.array([(i << 64) // owners for i in range(1, owners)], dtype=np.uint64)
    return values, np.concatenate(([0], np.searchsorted(values, edges), [len(values)]))


def _requests(owners: int):
    def send(block: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values, at = _owned(rows["fp"].to_numpy(np.int64), owners)
        out = [
            (o, block[0], rice.encode(values[at[o] : at[o + 1]] - np.uint64((o << 64) // owners),
                                      64 - (owners.bit_length() - 1)))
            for o in range(owners)
            if at[o + 1] > at[o]
        ]
        return pd.DataFrame(out, columns=["owner", "block", "codes"])

    return send


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    lists = [rice.decode(c) for c in rows["codes"]]
    every, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = every[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return pd.DataFrame({"owner": rows["owner"], "block": rows["block"], "bitmap": bitmaps})


def _suspects(owners: int):
    def mark(_: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy(np.int64)
        values, at = _owned(fps, owners)
        shared = np.zeros(len(values), bool)
        for owner, bitmap in zip(answers["owner"], answers["bitmap"], strict=True):
            n = int(at[owner + 1] - at[owner])
            bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool)
            shared[at[owner] : at[owner + 1]] = bits
        _, counts = np.unique(fps.view(np.uint64), return_counts=True)
        found = values[shared | (counts > 1)]
        return pd.DataFrame({"fp": found.view(np.int64)})

    return mark


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in _folded(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(map(_print, texts), pa.int64()),
             pa.array(texts, pa.binary())],
            ["doc_id", "fp", "folded"],
        )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.  Runs jobs."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    prints = written(source.mapInArrow(_prints, _PRINTS), "prints")
    owners = partitions_for(prints.count(), OWNER_ROWS)
    requests = prints.select("block", "fp").groupBy("block").applyInPandas(
        _requests(owners), "owner long, block string, codes binary"
    )
    answers = requests.groupBy("owner").applyInPandas(
        _answers, "owner long, block string, bitmap binary"
    )
    suspects = written(
        prints.select("block", "fp").groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(_suspects(owners), "fp long")
        .distinct(),
        "suspects",
    )
    # byte verification: equal bytes meet in the map-side aggregate, so a text copied a million
    # times is shuffled about once per task
    texts = source.mapInArrow(_keyed, "doc_id long, fp long, folded binary").join(
        suspects, "fp", "left_semi"
    )
    classes = texts.groupBy("fp", "folded").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    ).select("fp", F.sha2("folded", 256).alias("text_sha256"), "keep_id", "group_size")
    classes = written(classes, "classes")
    one = F.col("group_size").isNull()
    kept = F.when(one, True).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return prints.join(classes, ["fp", "text_sha256"], "left").select(
        "doc_id",
        F.when(one, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
    )
