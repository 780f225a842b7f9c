"""Disk that operators hold: shuffles go with the write they served, tables once they are read."""

import os
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallygate.llm import kneser_ney
from tallygate.llm.common import drop, written
from tallygate.llm.jaccard_join import Similarity, jaccard_components
from tallygate.llm.line_dedup import dedup_lines
from tallygate.session import checkpoint_folder


def _tables(spark):
    folder = f"{checkpoint_folder(spark)}/llm".removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def _left(spark, before):
    return sorted({t.rpartition("-")[0] for t in _tables(spark) - before})


def _shuffles(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker() \
        .shuffleStatuses().size()


@pytest.fixture
def near_copies(make_docs):
    base = [f"b{i}" for i in range(60)]
    return make_docs([" ".join([*base[: i % 50], f"x{i}", *base[i % 50 :]]) for i in range(60)])


def test_shuffles_go_with_the_write_they_served(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    written(rows, "warm-up")
    time.sleep(2)
    before = _shuffles(spark)
    written(rows, "counts")
    for _ in range(50):  # the cleaner has a thread of its own
        if _shuffles(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffles(spark) <= before


def test_join_keeps_only_what_its_result_reads(spark, near_copies):
    before = _tables(spark)
    found = jaccard_components(near_copies, Similarity(4, 85))
    assert _left(spark, before) == ["edges", "nodes"]
    assert {r.component_id for r in found.collect()} == {0}


def test_line_dedup_keeps_only_what_its_result_reads(spark, make_docs):
    before = _tables(spark)
    run = "\n".join(f"one two three four five {i}" for i in range(4))
    found = dedup_lines(make_docs([run, run + "\nnew"]))
    assert _left(spark, before) == ["gone"]
    assert {r.doc_id: r.text for r in found.collect()} == {0: run, 1: "new"}


def test_quality_keeps_no_messages(spark, sf_docs, sf_labels):
    before = _tables(spark)
    found = kneser_ney.quality(sf_docs, sf_labels)
    assert not {"pairs", "words"} & set(_left(spark, before))
    assert found.count() == sf_docs.count()


def test_pipeline_keeps_the_documents_of_its_last_stage_only(spark):
    before = _tables(spark)
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    names = [n for n, _ in corpus_pipeline.STAGES[:-1]]
    assert [n for n in _left(spark, before) if n in names] == ["mixing"]
    assert found.count() > 0


def test_only_written_tables_are_dropped(spark):
    with pytest.raises(KeyError):
        drop(spark.range(3))
