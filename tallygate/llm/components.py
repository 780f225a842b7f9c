"""Connected components by alternating large-star and small-star joins; no state on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import drop, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the root is the smallest node.

    Runs jobs: each round is written, so lineage stays one round long.  The minimum per node is
    pre-aggregated in the map tasks and joined back, so a node with a third of all links is many
    partial minima and a join whose hot side can be split.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), "edges",
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"),
                                                          F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "edges")
        drop(edges)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), "edges")
        drop(large)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
