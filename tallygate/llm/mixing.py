"""Document rates that bring soft domain memberships to target token weights.

*Memberships.*  A multinomial logistic model on hashed words and word beginnings, fitted on a
bounded sample of the labelled table, gives every document a posterior over the domains.

*Rates.*  With a_d the document's share of all tokens and p_d its posterior, rates r_d >= 0 minimise

    1/2 |sum over d of a_d r_d p_d - target|^2

and, of the rates that do, are those nearest to 1 (in squares weighted by a_d).  The projected
gradient step from 1 gives them the form r_d = max(0, 1 - p_d . dual), with one number per domain.
The dual step is scaled by the inverse of the Gram matrix of the documents whose rate is not
clipped to 0, so a rare domain converges as fast as a frequent one.  A round is one aggregate over
all documents, and a second one where the full step is too long.  Rounds end when the optimality
condition holds to ``tolerance``; a warning tells if it does not after ``rounds``.  A few numbers
are kept on the driver and no state on the executors: a lost executor costs a recomputation of its
partitions.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import (
    LOWER,
    Words,
    chunks,
    gives_back,
    small_batches,
    span_hashes,
    text_or_empty,
    texts_of,
    written,
)

DOMAINS = ("clean", "low", "toxic")


@dataclass(frozen=True)
class Mix:
    #: target share of the expected tokens by domain
    targets: Mapping[str, float] = field(
        default_factory=lambda: {"clean": 0.96, "low": 0.03, "toxic": 0.01})
    #: bound of the labelled sample, for each domain
    sample: int = 1500
    buckets: int = 1 << 15
    prefix_bytes: int = 5
    epochs: int = 60
    rounds: int = 30
    #: bound of the optimality residual, as a share of each target
    tolerance: float = 2e-5


# -------------------------------------------------------------------------- the classifier


def _features(texts: list[bytes], how: Mix) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text index, bucket and weight of every feature, and the number of words of each text.

    Words count with their case, and their beginnings without; weights are square roots of counts,
    scaled so that every text has length 1.
    """
    w = Words(texts, fold=None)
    words = span_hashes(w.buffer, w.starts, w.ends)
    begins = span_hashes(LOWER[w.buffer], w.starts, np.minimum(w.ends, w.starts + how.prefix_bytes))
    tails = span_hashes(w.buffer, np.maximum(w.ends - 2, w.starts), w.ends)
    half = np.uint64(how.buckets // 4)
    keys = np.concatenate([
        w.text * how.buckets + ((h % half) + np.uint64(k) * half).astype(np.int64)
        for k, h in enumerate((words, begins, tails))])
    unique, counts = np.unique(keys, return_counts=True)
    text, bucket = unique // how.buckets, unique % how.buckets
    weight = np.sqrt(counts)
    norm = np.sqrt(np.bincount(text, weights=weight**2, minlength=len(texts)))
    return text, bucket, weight / norm[text], np.diff(w.first)


def _encoded(how: Mix):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                text, bucket, weight, _ = _features(texts[a:b], how)
                at = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("domain").slice(a, b - a),
                     pa.array([bucket[i:j].astype(np.int32) for i, j in zip(at, at[1:])],
                              pa.list_(pa.int32())),
                     pa.array([weight[i:j].astype(np.float32) for i, j in zip(at, at[1:])],
                              pa.list_(pa.float32()))],
                    ["domain", "bucket", "weight"])

    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(sample: pa.Table, share: np.ndarray, how: Mix) -> np.ndarray:
    """Weights (bucket + 1, domain); the last row is the intercept.  ``share``: true domain shares.

    The bounded sample comes as flat arrays, a few bytes per distinct feature of a document.
    """
    k = len(DOMAINS)
    weights = np.zeros((how.buckets + 1, k))
    weights[-1] = np.log(np.maximum(share, 1e-6))
    if not sample.num_rows:
        return weights
    y = sample.column("domain").to_numpy()
    lists = sample.column("bucket").combine_chunks()
    bucket = lists.flatten().to_numpy()
    value = sample.column("weight").combine_chunks().flatten().to_numpy()
    text = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    truth = np.eye(k)[y]
    mine = np.bincount(y, minlength=k) / len(y)
    importance = (share / np.maximum(mine, 1e-9))[y]
    importance /= importance.mean()
    scale = np.zeros_like(weights)
    for _ in range(how.epochs):  # full-batch adaptive steps: the order of rows plays no part
        z = np.stack([np.bincount(text, weights=value * weights[bucket, j], minlength=len(y))
                      for j in range(k)], 1) + weights[-1]
        error = (_softmax(z) - truth) * importance[:, None]
        gradient = np.zeros_like(weights)
        for j in range(k):
            gradient[:-1, j] = np.bincount(bucket, weights=value * error[text, j],
                                           minlength=how.buckets)
        gradient[:-1] = gradient[:-1] / len(y) + 1e-6 * weights[:-1]
        gradient[-1] = error.mean(0)
        scale += gradient**2
        weights -= 0.5 * gradient / np.sqrt(scale + 1e-12)
    return weights


def _posteriors(shared, how: Mix):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                text, bucket, value, words = _features(texts[a:b], how)
                z = np.stack([np.bincount(text, weights=value * weights[bucket, j],
                                          minlength=b - a) for j in range(len(DOMAINS))], 1)
                p = _softmax(z + weights[-1])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"),
                     pa.array(words.astype(np.int64)),
                     *[pa.array(p[:, j]) for j in range(len(DOMAINS))]],
                    ["doc_id", "text_key", "n_tokens", *DOMAINS])

    return run


def posteriors(docs: DataFrame, labels: DataFrame, how: Mix) -> DataFrame:
    """(doc_id, text_key, n_tokens, one probability per domain).  Runs the jobs that fit the model."""
    spark = docs.sparkSession
    text = text_or_empty()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                         F.xxhash64(text).alias("text_key"))
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    known = known.select("doc_id", F.when(F.col("toxic") == 1, 2).when(
        F.col("quality") == 1, 0).otherwise(1).cast("long").alias("domain"))
    counts = {r["domain"]: r["n"] for r in
              known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    share = np.array([counts.get(k, 0) + 1.0 for k in range(len(DOMAINS))])
    order = F.xxhash64("doc_id", F.lit(8))
    ids = known.where(F.col("domain") == 0).orderBy(order).limit(how.sample)
    for k in range(1, len(DOMAINS)):
        ids = ids.union(known.where(F.col("domain") == k).orderBy(order).limit(how.sample))
    # at most ``sample`` ids for each domain: a broadcast of bounded size
    rows = source.join(F.broadcast(ids), "doc_id").select("domain", "text", "text_key").orderBy(
        "text_key", "domain").select("domain", "text")
    sample = rows.mapInArrow(
        _encoded(how), "domain long, bucket array<int>, weight array<float>").toArrow()
    weights = spark.sparkContext.broadcast(fit(sample, share / share.sum(), how))
    return source.mapInArrow(_posteriors(weights, how), ", ".join(
        ["doc_id long, text_key long, n_tokens long", *[f"{d} double" for d in DOMAINS]]))


# -------------------------------------------------------------------------------- the rates


#: Weight of the distance from rate 1; it bounds the dual where no rates reach the target.
_NEAR = 1e-9


def _rate(dual: np.ndarray) -> Column:
    move = sum((F.col(d) * F.lit(float(v)) for d, v in zip(DOMAINS, dual, strict=True)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - move)


def rates(members: DataFrame, how: Mix) -> DataFrame:
    """``members`` with the column rate.  Runs one or two aggregates over the documents a round.

    Tokens are summed exactly; the dual is rounded to 12 digits, so the order in which partial sums
    arrive hardly shows in the rates.
    """
    total = members.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    if not total:
        return members.withColumn("rate", F.lit(1.0))
    k = len(DOMAINS)
    target = np.array([how.targets[d] for d in DOMAINS], float)
    target /= target.sum()
    bound = how.tolerance * np.maximum(target, target[target > 0].min())
    share = F.col("n_tokens") / F.lit(float(total))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def at(duals: list[np.ndarray]) -> list[tuple[np.ndarray, float, np.ndarray, np.ndarray]]:
        """Per dual: itself, the dual objective, the residual of its gradient, the Gram matrix."""
        sums = []
        for dual in duals:
            rate = _rate(dual)
            used = F.when(rate > 0, share).otherwise(0.0)
            sums += [F.sum(share * rate * rate), *[F.sum(share * rate * F.col(d)) for d in DOMAINS],
                     *[F.sum(used * F.col(DOMAINS[i]) * F.col(DOMAINS[j])) for i, j in pairs]]
        row = np.array(members.agg(*[x.alias(f"sum_{n}") for n, x in enumerate(sums)]).first(), float)
        out = []
        for dual, one in zip(duals, row.reshape(len(duals), -1), strict=True):
            gram = np.zeros((k, k))
            for (i, j), v in zip(pairs, one[k + 1:], strict=True):
                gram[i, j] = gram[j, i] = v
            out.append((dual, one[0] / 2 + target @ dual + _NEAR / 2 * (dual @ dual),
                        one[1 : k + 1] - target - _NEAR * dual, gram))
        return out

    dual, height, off, gram = at([np.zeros(k)])[0]
    for _ in range(how.rounds):
        if (np.abs(off) <= bound).all():
            break
        step = np.linalg.solve(gram + _NEAR * np.eye(k), off)
        slope = float(off @ step)

        def lower(found, length: float, height=height, slope=slope) -> bool:
            return found[1] <= height - 1e-4 * length * slope + 1e-12 * abs(height)

        best = at([np.round(dual + step, 12)])[0]
        if not lower(best, 1.0):
            lengths = [0.25**j for j in range(1, 13)]
            tried = at([np.round(dual + step * x, 12) for x in lengths])
            best = next((f for f, x in zip(tried, lengths, strict=True) if lower(f, x)), tried[-1])
        dual, height, off, gram = best
    if not (np.abs(off) <= bound).all():
        warnings.warn(f"rates not optimal after {how.rounds} rounds: residuals "
                      f"{dict(zip(DOMAINS, off.tolist(), strict=True))}", RuntimeWarning, stacklevel=2)
    return members.withColumn("rate", F.round(_rate(dual), 9))


def mix(docs: DataFrame, labels: DataFrame, how: Mix = Mix()) -> DataFrame:
    """One row per document: doc_id, text_key, n_tokens, a posterior per domain, rate.  Runs jobs.

    The rate is the expected number of copies of the document in the mixture; targets that no rates
    reach get the nearest total, which can take large rates.  Defined results: a
    null or empty text has no tokens, the base rates as posterior, and the rate that posterior
    gets; labels with a null, or conflicting labels (toxic if any is, else low if any is) do not
    fail; without labels all posteriors are equal; repeated rows each get the same rate; without
    any token every rate is 1; an empty table gives an empty result; other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        members = written(posteriors(docs, labels, how), "posteriors")
    return rates(members, how)


def copies(rate: Column, key: Column) -> Column:
    """Number of copies to emit: the rate's whole part, and one more with its fraction as chance."""
    chance = F.pmod(F.xxhash64(key, F.lit(8)), F.lit(1_000_000)) / 1_000_000.0
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")
