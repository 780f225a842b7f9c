"""Training-data pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the result is
written as Parquet and read again.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm import bpe, jaccard_join, kneser_ney, line_dedup, mixing
from tallygate.llm.common import drop, key_of, read, small_batches, text_or_empty, written
from tallygate.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _ids() -> Column:
    return F.col("doc_id").cast("long")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is in the range of trusted text of their language stay.

    Rows equal in doc_id and text share the decision; documents without words stay.
    """
    decided = kneser_ney.quality(docs, read(spark, sf_dir, "labels"))
    # written, so the join knows its size: texts are shuffled only when it is too large to broadcast
    rejected = written(decided.where(~F.col("accepted")).select("row_key").distinct(), "rejected")
    keyed = docs.select(*COLUMNS).withColumn("row_key", key_of(_ids(), text_or_empty()))
    return keyed.join(rejected, "row_key", "left_anti").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated line runs are cut out whole.

    A document of which only blank lines are left goes: each of its lines stands in an earlier one.
    Documents without words from the start stay.
    """
    left = line_dedup.dedup_lines(docs, carry=("lang", "source")).where(
        (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^ \n]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id.

    Documents without words are in no group and stay.  A null doc_id comes after all others, then
    the text's hash decides; of rows that repeat a doc_id and a text one stays.
    """
    placed = written(jaccard_join.jaccard_components(docs), "components")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    worded = placed.where("n_shingles > 0")
    stays = worded.groupBy("root").agg(F.min(rank).alias("stays"))
    keys = worded.join(stays, "root").groupBy("doc_id", "text_key").agg(
        F.bool_or(rank != F.col("stays")).alias("goes"), F.count("*").alias("times")
    ).where("goes or times > 1").select(
        key_of("doc_id", "text_key").alias("row_key"), "goes")
    keys = written(keys, "near_copies")
    text_key = key_of(text_or_empty())
    keyed = docs.select(*COLUMNS).withColumn("row_key", key_of(_ids(), text_key))
    others = keyed.join(keys.select("row_key"), "row_key", "left_anti")
    repeated = keyed.join(keys.where(~F.col("goes")).select("row_key"), "row_key", "left_semi")
    return others.select(*COLUMNS).union(
        repeated.dropDuplicates(["row_key"]).select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is emitted as often as its rate says.

    A document that the classifier calls clean is emitted at least once; one without tokens counts
    for no domain and is emitted once.
    """
    mixed = mixing.mix(docs, read(spark, sf_dir, "labels"))
    best = F.greatest(*mixing.DOMAINS)
    kept = (F.col("clean") == best) | (F.col("n_tokens") == 0)
    times = mixing.copies(F.col("rate"), F.col("text_key"))
    times = F.when(F.col("n_tokens") == 0, 1).when(kept, F.greatest(times, F.lit(1))).otherwise(
        times)
    plan = mixed.select("text_key", times.alias("times")).groupBy("text_key").agg(
        F.max("times").alias("times"))
    keyed = docs.select(*COLUMNS).withColumn("text_key", F.xxhash64(text_or_empty()))
    return keyed.join(plan, "text_key").where("times > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: doc_id, n_tokens, ids."""
    found = bpe.encode_documents(docs, tokenizer_path())
    # written here, where batches are small: a caller's job would move 10,000 texts in one
    with small_batches(spark):
        return written(
            found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_join_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The first, fourth and fifth stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    made = []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        drop(*made)  # the documents the stage has read
        made = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
