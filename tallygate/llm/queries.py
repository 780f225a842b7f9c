"""Registered queries of the operators: each applies one to its whole intended table.

The operators return real outputs (texts, spans, ids); the queries derive the digests that keep
results small to compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    html_text,
    jaccard_join,
    kneser_ney,
    line_dedup,
    mixing,
    packing,
    posting_lists,
    secret_scan,
    threshold_clusters,
    toxicity,
)
from tallygate.llm.common import read
from tallygate.llm.oracle import ORACLE_SQL

#: The similarity join's contract: four-word shingles, 85 %.
JOIN = jaccard_join.Similarity(words=4, percent=85)
TOXIC_FROM = 0.3


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, the limit of its language, and the decision."""
    found = kneser_ney.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "n_words", "log_perplexity", "threshold", "accepted")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(read(spark, sf_dir, "documents")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op4_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(read(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_documents(read(spark, sf_dir, "documents"), tokenizer_path())
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, and the deleted runs as first-last line numbers."""
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    runs = F.transform("runs", lambda r: F.concat_ws("-", r["first"].cast("string"),
                                                     r["last"].cast("string")))
    return found.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_deleted").cast("long").alias("n_deleted"), F.array_join(runs, ",").alias("runs"),
        "text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, tokens and rate of every document."""
    found = mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", *[F.round(d, 9).alias(d) for d in mixing.DOMAINS],
                        "rate")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score",
                        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), JOIN)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(read(spark, sf_dir, "documents"),
                                   tokenizer_path("byte_bpe_50k.json"), with_ids=False)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                        "offset")


def op12_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threshold_clusters.cluster(read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_secret_scan, op3_exact_dedup, op4_posting_lists, op5_bpe,
        op6_html_text, op7_line_dedup, op8_mixing, op9_toxicity, op10_jaccard_join, op11_packing,
        op12_threshold_clusters, op13_hard_negatives,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
