"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

*Model.*  Words are split at white space and known by a 64-bit hash.  Every word of the trusted
texts is in the vocabulary, which nothing holds as a whole: the counts of all n-grams, single words
included, of their contexts and of their continuations are Spark tables.  A word they never show has
the back-off probability.  With a ``vocabulary_share`` above 0, words below that share of the trusted
tokens are instead one class whose probability is shared evenly by the distinct words it stands for.

*Scoring.*  With interpolation folded in, log p(w | h) is a sum of independent terms

    base + delta_1(w) + sum over k of [log gamma_k(h_k) + delta_k(h_k w)],

where base is the back-off log probability of a word and delta_k is zero for an n-gram the model
does not hold.  A document's log probability is
therefore a sparse dot product of its n-gram counts and one weight per n-gram.  Weights of n-grams
above ``hot_share`` (at most 1 / share of each order) go to every task, as a cache that changes no
result; all others are looked up by a join of (n-gram, document) rows with the weight table, sharded
by n-gram.  That is ``train`` and ``score``, for every order and vocabulary.  ``quality`` with a
bigram model of every word, its default, counts and scores in ``gram_exchange`` instead, where only
distinct n-grams of blocks of documents are shuffled, coded; the model and its values are the same.

*Decision.*  A fifth of the trusted documents, by hash, is kept out of training.  Per language, a
document is rejected when its log perplexity exceeds the ``quantile`` of those documents by more
than ``margin``.  Short texts say little, so ``prior_words`` words at the language's median are
mixed into every document's mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm import gram_exchange
from tallygate.llm.common import Words, chunks, key_of, mix, text_or_empty, texts_of, written
from tallygate.llm.marks import id_words, marked

UNKNOWN, START, END = mix(np.arange(1, 4)).view(np.int64).tolist()
BITS = 21  # a word's hash is turned by so many bits for each word that follows it


@dataclass(frozen=True)
class Settings:
    order: int = 2
    #: 0 keeps every word
    vocabulary_share: float = 0.0
    hot_share: float = 2e-6
    held_out: int = 5
    quantile: float = 0.99
    margin: float = 0.05
    prior_words: float = 20.0
    #: held-out trusted documents a language needs for a threshold of its own
    least_documents: int = 20


# --------------------------------------------------------------------------- inside the tasks


def gram_keys(words: list[np.ndarray]) -> np.ndarray:
    """Keys of n-grams; ``words`` holds their word hashes, the last word first."""
    out = words[0].view(np.uint64)
    for back, word in enumerate(words[1:], 1):
        turn, word = np.uint64(BITS * back), word.view(np.uint64)
        out = out ^ ((word << turn) | (word >> (np.uint64(64) - turn)))
    return out.view(np.int64)


def _gram_key(words: list[str]) -> Column:
    """``gram_keys`` of columns."""
    out = F.col(words[0])
    for back, word in enumerate(words[1:], 1):
        out = out.bitwiseXOR(F.shiftleft(word, BITS * back).bitwiseOR(
            F.shiftrightunsigned(word, 64 - BITS * back)))
    return out


class Sequences:
    """Word hashes of several texts with order - 1 starts and one end around each.

    Words outside ``vocabulary`` (sorted hashes) are one class; without it every word is known.
    """

    def __init__(self, texts: list[bytes], vocabulary: np.ndarray | None, order: int) -> None:
        w = Words(texts, fold=None)
        h = w.hashes().view(np.int64)
        known = np.ones(len(h), bool) if vocabulary is None else _found(h, vocabulary)[1]
        docs = len(texts)
        sizes = np.diff(w.first)
        begin = w.first[:-1] + np.arange(docs) * order
        self.ids = np.full(len(h) + docs * order, START, np.int64)
        self.ids[np.arange(len(h)) + w.text * order + order - 1] = np.where(
            known, h, UNKNOWN)
        ends = begin + order - 1 + sizes
        self.ids[ends] = END
        event = np.ones(len(self.ids), bool)
        for k in range(order - 1):
            event[begin + k] = False
        self.at = np.flatnonzero(event)
        self.text = np.repeat(np.arange(docs), sizes + 1)
        self.sizes = sizes
        self.unknown = np.bincount(w.text[~known], minlength=docs)

    def words(self, level: int) -> list[np.ndarray]:
        return [self.ids[self.at - back] for back in range(level)]

    def keys(self, level: int) -> np.ndarray:
        return gram_keys(self.words(level))


class Tally:
    """Counts of n-grams, combined in the task and handed on when many."""

    def __init__(self, limit: int = 1 << 19) -> None:
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k, at, c = np.unique(gram_keys(words), return_index=True, return_counts=True)
        self.parts.append((k, c, [w[at] for w in words]))
        self.size += len(k)
        if self.size > 4 * self.limit:
            self._combine()
            if self.size > 2 * self.limit:
                yield from self.flush()

    def _combine(self) -> None:
        keys = np.concatenate([k for k, _, _ in self.parts])
        counts = np.concatenate([c for _, c, _ in self.parts])
        words = [np.concatenate(w) for w in zip(*[w for _, _, w in self.parts], strict=True)]
        k, at, to = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(to, weights=counts, minlength=len(k)).astype(np.int64)
        self.parts = [(k, counts, [w[at] for w in words])]
        self.size = len(k)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._combine()
            (_, c, words), self.parts, self.size = self.parts[0], [], 0
            for i in range(0, len(c), 200_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[i : i + 200_000]) for x in (*words, c.astype(np.int64))],
                    [*[f"w{j}" for j in range(len(words))], "c"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for batch in batches:
        texts = texts_of(batch.column("text"))
        for a, b in chunks(texts):
            yield from tally.add([Words(texts[a:b], fold=None).hashes().view(np.int64)])
    yield from tally.flush()


def _gram_counts(vocabulary, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                yield from tally.add(Sequences(texts[a:b], vocabulary.value, order).words(order))
        yield from tally.flush()

    return run


def _found(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                s = Sequences(texts[a:b], m["vocabulary"], m["order"])
                total = np.full(len(s.at), m["base"])
                for level in range(1, m["order"] + 1):
                    at, hit = _found(s.keys(level), m["keys"])
                    if len(m["weights"]):
                        total = total + np.where(hit, m["weights"][at], 0.0)
                score = np.bincount(s.text, weights=total, minlength=b - a) + m["constant"]
                score -= s.unknown * m["spread"]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("row_key", "doc_id", "lang", "held_out")]
                    + [pa.array(s.sizes.astype(np.int64)), pa.array(score)],
                    ["row_key", "doc_id", "lang", "held_out", "n_words", "score"])

    return run


def _tail(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                s = Sequences(texts[a:b], m["vocabulary"], m["order"])
                row_keys = batch.column("row_key").slice(a, b - a).to_numpy(zero_copy_only=False)
                for level in range(1, m["order"] + 1):
                    keys = s.keys(level)
                    rare = ~_found(keys, m["keys"])[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row_keys[s.text[rare]]), pa.array(keys[rare])],
                        ["row_key", "key"])

    return run


# ------------------------------------------------------------------------------------ the model


@dataclass
class Model:
    #: hashes of the words that are not one class; None: every word
    vocabulary: np.ndarray | None
    base: float
    spread: float
    constant: float
    #: (key, w, share) of the n-grams of every order
    weights: DataFrame


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many n-grams have counts 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [i - (i + 1) * y * b / a if a else i * 0.5
           for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.05 * i), 0.95 * i) for i, d in enumerate(out, 1))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    return discounts_of(*table.agg(
        *[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first())


def _discount(d: tuple[float, float, float]) -> Column:
    c = F.col("c")
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _frequent(trusted: DataFrame, how: Settings) -> tuple[np.ndarray, int]:
    """Sorted hashes of the words that reach the share (at most 1 / share), and the number of types."""
    words = written(
        trusted.select("text").mapInArrow(_word_counts, "w0 long, c long")
        .groupBy("w0").agg(F.sum("c").alias("c")), "words")
    tokens, types = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = words.where(F.col("c") >= F.lit(how.vocabulary_share * tokens))
    return np.sort(frequent.select("w0").toArrow().to_pandas()["w0"].to_numpy(np.int64)), types


def train(trusted: DataFrame, how: Settings) -> Model:
    """Count the trusted texts and derive one weight per n-gram.  Runs jobs."""
    spark = trusted.sparkSession
    vocabulary, types = _frequent(trusted, how) if how.vocabulary_share > 0 else (None, 0)
    shared = spark.sparkContext.broadcast(vocabulary)
    names = [f"w{j}" for j in range(how.order)]  # the last word first
    tables = {how.order: written(
        trusted.select("text").mapInArrow(
            _gram_counts(shared, how.order), ", ".join(f"{n} long" for n in [*names, "c"]))
        .groupBy(*names).agg(F.sum("c").alias("c")).sortWithinPartitions(names[-1]), "grams")}
    for level in range(how.order - 1, 0, -1):
        # continuation counts; nothing precedes a start, so n-grams that begin with it keep theirs
        one = F.when((F.lit(level) > 1) & (F.col(names[level - 1]) == START), F.col("c")).otherwise(1)
        tables[level] = written(
            tables[level + 1].groupBy(*names[:level]).agg(F.sum(one).alias("c")), "grams")

    discounts = {k: _discounts(t) for k, t in tables.items()}
    gammas, probabilities, weights = {}, {}, {}
    d = _discount(discounts[1])
    total, mass, kept = tables[1].agg(
        F.sum("c"), F.sum(d), F.count_if(F.col("w0") != END)).first()
    # the class of unknown words and the end are two types more
    size = (kept if vocabulary is None else len(vocabulary)) + 2
    gamma = mass / total if total else 1.0
    # what the trusted text never shows has the back-off probability
    base = float(np.log(gamma / size))
    for level in range(1, how.order + 1):
        d = _discount(discounts[level])
        if level == 1:
            t = tables[1].withColumnRenamed("w0", "key").withColumns({
                "tot": F.lit(float(total or 1)), "gamma": F.lit(float(gamma)),
                "lower": F.lit(1.0 / size)})
        else:
            t = tables[level].select(
                _gram_key(names[1:level]).alias("ctx"), _gram_key(names[: level - 1]).alias("suf"),
                "w0", "c")
            g = gammas[level] = written(t.groupBy("ctx").agg(
                F.sum("c").alias("tot"), (F.sum(d) / F.sum("c")).alias("gamma")), "contexts")
            low = probabilities[level - 1].select(F.col("key").alias("suf"),
                                                  F.col("p").alias("lower"))
            # the key follows from last word and context: it is not shuffled beside them
            t = t.join(g, "ctx").select(
                _gram_key(["w0", "ctx"]).alias("key"), "suf", "c", "tot", "gamma").join(low, "suf")
        p = t.withColumn("p", (F.col("c") - d) / F.col("tot") + F.col("gamma") * F.col("lower"))
        delta = F.log("p") - F.log("gamma") - F.log("lower")
        needed = ["p"] if level < how.order else []
        weights[level] = written(p.select("key", "c", *needed, delta.alias("w")), "weights")
        probabilities[level] = weights[level]

    constant = 0.0
    for level in range(2, how.order + 1):
        start = int(gram_keys([np.array([START])] * (level - 1))[0])
        row = gammas[level].where(F.col("ctx") == start).select("gamma").first()
        constant += float(np.log(row[0])) if row else 0.0
        lower = gammas[level].select(F.col("ctx").alias("key"), F.log("gamma").alias("g"))
        weights[level - 1] = written(weights[level - 1].join(lower, "key", "left").select(
            "key", "c", (F.col("w") + F.coalesce("g", F.lit(0.0))).alias("w")), "weights")

    rest = []
    for level in range(1, how.order + 1):
        total = tables[level].agg(F.coalesce(F.sum("c"), F.lit(1))).first()[0]
        rest.append(weights[level].select("key", "w", (F.col("c") / F.lit(total)).alias("share")))
    table = rest[0]
    for more in rest[1:]:
        table = table.union(more)
    spread = 0.0 if vocabulary is None else float(np.log(max(1, types - len(vocabulary))))
    return Model(vocabulary, base, spread, constant, table)


def score(rows: DataFrame, model: Model, how: Settings) -> DataFrame:
    """(doc_id, lang, held_out, n_words, log_perplexity) of rows with (doc_id, text, lang, held_out)."""
    spark = rows.sparkSession
    # at most 1 / hot_share n-grams of each order; the others are joined
    hot = model.weights.where(F.col("share") >= how.hot_share).select("key", "w").toArrow().to_pandas()
    hot = hot.sort_values("key")
    shared = spark.sparkContext.broadcast({
        "vocabulary": model.vocabulary, "base": model.base, "order": how.order,
        "spread": model.spread, "constant": model.constant,
        "keys": hot["key"].to_numpy(np.int64), "weights": hot["w"].to_numpy(np.float64)})
    keyed = rows.withColumn("row_key", key_of("doc_id", "text"))
    base = written(keyed.select("row_key", "doc_id", "lang", "held_out", "text").mapInArrow(
        _scores(shared),
        "row_key long, doc_id long, lang string, held_out boolean, n_words long, score double"),
        "scores")
    tail = keyed.select("row_key", "text").mapInArrow(_tail(shared), "row_key long, key long")
    cold = model.weights.where(F.col("share") < how.hot_share).select("key", "w")
    more = tail.join(cold, "key").groupBy("row_key").agg(F.sum("w").alias("more"))
    # rows equal in id and text share a key: their sums are divided by their number
    copies = base.groupBy("row_key").agg(F.count("*").alias("copies"))
    more = more.join(copies, "row_key").select("row_key", (F.col("more") / F.col("copies"))
                                               .alias("more"))
    return base.join(more, "row_key", "left").select(
        "doc_id", "lang", "held_out", "n_words",
        (-(F.col("score") + F.coalesce("more", F.lit(0.0))) / (F.col("n_words") + 1))
        .alias("log_perplexity"), "row_key")


def _quantiles(scores: DataFrame, how: Settings) -> DataFrame:
    """(lang, middle, high, n): of held-out trusted documents, exact to a bin of 0.001.

    Bins are pre-aggregated counts, so a language with most rows is a few thousand rows; the
    window runs over bins, never over documents.  The null lang holds documents without language.
    """
    from pyspark.sql import Window

    bins = scores.where("held_out and n_words > 0").groupBy(
        "lang", F.floor(F.col("log_perplexity") * 1000).alias("bin")).agg(F.count("*").alias("n"))
    every = bins.groupBy("bin").agg(F.sum("n").alias("n"))
    bins = bins.select(F.lit(False).alias("overall"), "lang", "bin", "n").union(
        every.select(F.lit(True), F.lit(None).cast("string"), "bin", "n"))
    group = Window.partitionBy("overall", "lang")
    run = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn(
        "all", F.sum("n").over(group))

    def at(q: float) -> Column:
        return (F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) + 1) / 1000

    return run.groupBy("overall", "lang").agg(
        at(0.5).alias("middle"), at(how.quantile).alias("high"), F.max("all").alias("n"))


def quality(docs: DataFrame, labels: DataFrame, how: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, lang, n_words, log_perplexity, threshold, accepted, row_key.

    ``labels`` (doc_id, quality) names the trusted documents: those all of whose labels are 1.
    Runs jobs.  Defined results: a null text counts as empty; a text without words is accepted (it
    has no perplexity to reject it by); a null language is a language of its own; a language with
    fewer than ``least_documents`` held-out trusted documents takes the overall threshold; without
    any trusted text everything is accepted.  Repeated rows each get their row's result; row_key
    finds it again.  Other columns are ignored.
    """
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("q")).where("q = 1")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(how.held_out)) == 0
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         text_or_empty().alias("text"),
                         F.col("lang").cast("string").alias("lang"))
    rows = marked(source, "doc_id", [(id_words(label, "doc_id", "trusted"), "trusted")])
    rows = rows.withColumn("held_out", F.col("trusted") & part)
    trained = F.col("trusted") & ~F.col("held_out")
    if how.order == 2 and how.vocabulary_share == 0:
        scores = gram_exchange.perplexities(
            rows.withColumn("row_key", key_of("doc_id", "text")).withColumn("trained", trained))
    else:
        scores = written(score(rows, train(rows.where(trained), how), how), "perplexity")
    limits = _quantiles(scores, how)
    overall = limits.where("overall").select(
        F.col("middle").alias("m0"), F.col("high").alias("h0"), F.lit(1).alias("one"))
    own = limits.where((~F.col("overall")) & (F.col("n") >= how.least_documents)).select(
        F.col("lang").alias("of"), "middle", "high")
    joined = scores.join(own, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "one", F.lit(1)).join(overall, "one", "left")
    middle, high = F.coalesce("middle", "m0"), F.coalesce("high", "h0")
    n = F.col("n_words")
    shrunk = (F.col("log_perplexity") * n + middle * how.prior_words) / (n + how.prior_words)
    return joined.select(
        "doc_id", "lang", "n_words", F.round("log_perplexity", 6).alias("log_perplexity"),
        high.alias("threshold"),
        F.coalesce((n == 0) | (shrunk <= high + how.margin), F.lit(True)).alias("accepted"),
        "row_key")
