"""Repeated runs of lines, found by winnowing and deleted where they occur again.

A *window* is the shortest run of non-blank lines from some line on that reaches ``lines`` lines or
``words`` words.  Equal content has equal windows.  Each window selects the smallest of its line
hashes as fingerprint, so two places that share a window share a fingerprint at the same offset
(the winnowing guarantee), while most fingerprints occur once and go no further.

The positions of repeated fingerprints are joined with the first position of the same content, in
the order of doc_id, text hash and line, and matches are extended both ways: a line is deleted if
and only if it lies in a stretch of equal lines that holds a window and occurs earlier, anywhere.
To its left a match is extended by the windows that begin there, each with a match of its own.  The
last short lines of a run begin no window inside it, so a match is extended to its right by the next
lines, up to ``lines`` in all: were more lines equal, they would hold the next line's window.  Only
repeated windows are extended.  Without ``Window.ends`` the extension to the right is left out.

Only SQL functions are used.  A passage in a third of all documents is a pre-aggregated minimum
and a join back to it; no pairs of documents are formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import drop, text_or_empty, written

_FIRST = -(1 << 63)


@dataclass(frozen=True)
class Window:
    lines: int = 3
    words: int = 10
    #: extend matches to their right, so a repeated run goes to its last line
    ends: bool = True


def _identified(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *carry
    ).withColumns({
        "_d": F.coalesce("doc_id", F.lit(_FIRST)), "_h": F.xxhash64("text"),
    })


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _windows(rows: DataFrame, how: Window) -> DataFrame:
    """(_d, _h, fp, content, start, at): every window with its fingerprint and line numbers.

    With ``ends`` also the hashes and numbers of the next lines: (next, next_at).
    """
    def entry(x: Column, i: Column) -> Column:
        bare = F.replace(x, F.lit(" "), F.lit(""))
        return F.struct(i.alias("i"), F.xxhash64(x).alias("h"),
                        (F.length(x) - F.length(bare) + 1).alias("w"), F.length(bare).alias("n"))

    entries = F.filter(F.transform(_lines(), entry), lambda e: e["n"] > 0)
    rows = rows.select("_d", "_h", entries.alias("e"))

    def window(x: Column, k: Column) -> Column:
        length, total = F.lit(how.lines), F.lit(0)
        sums = []
        for j in range(how.lines - 1):
            total = total + F.coalesce(F.get(F.col("e"), k + j)["w"], F.lit(0))
            sums.append(total)
        for j in range(how.lines - 2, -1, -1):
            length = F.when(sums[j] >= how.words, j + 1).otherwise(length)
        after = [F.slice(F.col("e"), k + 1 + length, F.lit(how.lines) - length).alias("after")]
        return F.struct(k.alias("k"), F.slice(F.col("e"), k + 1, length).alias("part"),
                        length.alias("length"), *(after if how.ends else []))

    found = F.filter(F.transform("e", window), lambda v: F.size(v["part"]) == v["length"])
    following = [F.col("v.after.h").alias("next"), F.col("v.after.i").alias("next_at")]
    return rows.select("_d", "_h", F.explode(found).alias("v")).select(
        "_d", "_h",
        F.array_min(F.col("v.part.h")).alias("fp"),
        F.xxhash64(F.col("v.part.h"), F.col("v.length")).alias("content"),
        F.col("v.k").alias("start"),
        F.col("v.part.i").alias("at"),
        *(following if how.ends else []),
    )


def _place() -> Column:
    """Two hashes differ where two places do."""
    return F.xxhash64("_d", "_h", "start")


def _repeated(windows: DataFrame) -> DataFrame:
    """Windows whose content is at more than one place, with the first of these places."""
    first = windows.groupBy("content").agg(
        F.min(F.struct("_d", "_h", "start")).alias("first"), F.min(_place()).alias("lo"),
        F.max(_place()).alias("hi"),
    ).where("lo <> hi").select("content", "first")
    return windows.join(first, "content")


def _extended(repeated: DataFrame) -> DataFrame:
    """Repeated windows with each number of next lines; ``at`` holds the added lines only."""
    length = F.explode(F.sequence(F.lit(1), F.size("next"))).alias("more")
    return repeated.where(F.size("next") > 0).select("*", length).select(
        "_d", "_h", "start",
        F.xxhash64("content", F.slice("next", 1, F.col("more"))).alias("content"),
        F.slice("next_at", 1, F.col("more")).alias("at"))


def repeated_lines(docs: DataFrame, how: Window = Window()) -> DataFrame:
    """(_d, _h, gone), written: sorted numbers of the lines to delete of documents that have any."""
    windows = written(_windows(_identified(docs, ()), how), "windows")
    # fingerprints at more than one place
    several = windows.groupBy("fp").agg(F.min(_place()).alias("lo"), F.max(_place()).alias("hi")).where(
        "lo <> hi").select("fp")
    matches = windows.join(several, "fp", "left_semi")
    # content decides the fingerprint; grouping by it alone spreads a frequent fingerprint
    found = _repeated(matches)
    later = F.struct("_d", "_h", "start") != F.col("first")
    if how.ends:
        found = written(found, "repeated")
        drop(windows)
        windows = found
        gone = found.where(later).select("_d", "_h", "at").union(
            _repeated(_extended(found)).where(later).select("_d", "_h", "at"))
    else:
        gone = found.where(later)
    gone = written(gone.groupBy("_d", "_h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("gone")), "gone")
    drop(windows)
    return gone


def dedup_lines(docs: DataFrame, how: Window = Window(), carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_lines, n_deleted, runs, and ``carry``.

    runs lists the deleted stretches as (first, last) line numbers.  Runs a job.  Defined results:
    a null text counts as empty and stays empty; blank lines neither match nor are deleted, and a
    run may reach across them; documents without id come first in the order; rows equal in doc_id
    and text are one document, and each gets its result (none is a repetition of the other); an
    empty table gives an empty result; columns not named in ``carry`` are dropped.
    """
    # the text is split after the join, so it is shuffled once
    rows = _identified(docs, carry).join(repeated_lines(docs, how), ["_d", "_h"], "left").withColumn(
        "_lines", _lines())
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n"))

    def edge(step: int) -> Column:
        return F.filter(gone, lambda x, i: F.coalesce(
            F.get(gone, i + step) != x + step, F.lit(True)))

    runs = F.arrays_zip(edge(-1).alias("first"), edge(1).alias("last"))
    return rows.select(
        "doc_id", left.alias("text"), F.size("_lines").alias("n_lines"),
        F.size(gone).alias("n_deleted"),
        runs.alias("runs"), *carry)
