"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored by context.

*Lexicon.*  Terms are learned from a bounded sample of labelled training rows: words, and stems
(word beginnings shared by many different words), that are much more frequent in toxic texts.

*Automaton.*  Words of ``fuzzy_letters`` letters or more match within one insertion, deletion or
substitution, others and stems exactly.  The union of the terms' Levenshtein automata is walked
together with the trie of the terms and made deterministic once; tasks then move all words of many
texts through its table at the same time, one letter a step.

*Context.*  Every hit is weighed by its window: hits between quotation marks count ``quoted`` times,
hits near other hits more.  A logistic model of the sums, fitted on the same sample, gives the score.
Only the text enters a score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import text_or_empty

#: Texts are handled in groups of about this many characters.
GROUP_CHARS = 1 << 20
_QUOTES = '"“”„«»'


@dataclass(frozen=True)
class Settings:
    #: bounds of the labelled sample
    toxic_rows: int = 4000
    clean_rows: int = 8000
    #: bound of the lexicon
    most_terms: int = 300
    #: toxic texts of the sample a term must occur in, as a number and as a share
    least_texts: int = 5
    least_share: float = 0.015
    least_odds: float = 3.0
    fuzzy_letters: int = 5
    #: log odds from which a term's misspellings count, and how much one counts
    fuzzy_odds: float = 5.5
    misspelled: float = 0.5
    stem_lengths: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    window_words: int = 8
    window_chars: int = 80
    quoted: float = 0.25


@dataclass
class Lexicon:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    odds: dict[str, float] = field(default_factory=dict)


# ------------------------------------------------------------------------- trie and automaton


@dataclass
class Automaton:
    #: class of a character, 0 for every character no term holds
    alphabet: dict[str, int]
    #: next state by state and class; state 0 is dead, 1 the start
    moves: np.ndarray
    #: by state: 0 no term, 1 a term, 2 a misspelled term; and the term's number
    verdict: np.ndarray
    term: np.ndarray
    terms: list[str]


def build(lexicon: Lexicon, how: Settings) -> Automaton:
    """Deterministic union of the terms' automata, walked along the tries."""
    terms = lexicon.words + lexicon.stems
    alphabet = {c: i + 1 for i, c in enumerate(sorted(set("".join(terms))))}
    children: list[dict[int, int]] = [{}, {}]  # tries: 0 within one edit, 1 exact
    final: dict[int, tuple[int, bool]] = {}
    for number, term in enumerate(terms):
        stem = number >= len(lexicon.words)
        plain = stem or len(term) < how.fuzzy_letters or lexicon.odds[term] < how.fuzzy_odds
        node = 1 if plain else 0
        for c in term:
            nxt = children[node].get(alphabet[c])
            if nxt is None:
                nxt = len(children)
                children.append({})
                children[node][alphabet[c]] = nxt
            node = nxt
        final[node] = (number, stem)

    def skipped(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With the deletions: one letter of the term left out."""
        out = set(states)
        for node, edits in states:
            if edits == 0:  # fuzzy trie, no edit yet
                out.update((child, 1) for child in children[node].values())
        return frozenset(out)

    # a state is a node and its edits; edits 2 marks the exact trie
    start = skipped({(0, 0), (1, 2)})
    numbers = {start: 1}
    pending, rows, verdicts, found = [start], [], [], []
    classes = len(alphabet) + 1

    def number_of(states: set[tuple[int, int]]) -> int:
        for node, edits in states:
            if edits == 2 and node in final and final[node][1]:
                states = {(-1 - final[node][0], 2)}  # a stem: whatever follows
                break
        key = skipped(states) if states else frozenset()
        if not key:
            return 0
        if key not in numbers:
            numbers[key] = len(numbers) + 1
            pending.append(key)
        return numbers[key]

    at = 0
    while at < len(pending):
        states = pending[at]
        at += 1
        verdict, term = 0, 0
        best = 3
        for node, edits in states:
            if node < 0:
                verdict, term, best = 1, -1 - node, 0
            elif node in final and not final[node][1]:
                cost = 0 if edits == 2 else edits
                if cost < best:
                    verdict, term, best = (1 if cost == 0 else 2), final[node][0], cost
        verdicts.append(verdict)
        found.append(term)
        row = []
        for c in range(classes):
            nxt: set[tuple[int, int]] = set()
            for node, edits in states:
                if node < 0:
                    nxt.add((node, 2))
                    continue
                child = children[node].get(c)
                if child is not None:
                    nxt.add((child, edits))
                if edits == 0:
                    nxt.add((node, 1))  # one letter too many
                    nxt.update((other, 1) for k, other in children[node].items() if k != c)
            row.append(number_of(nxt))
        rows.append(row)
    moves = np.zeros((len(rows) + 1, classes), np.int32)
    moves[1:] = rows
    return Automaton(alphabet, moves, np.array([0, *verdicts], np.int8),
                     np.array([0, *found], np.int32), terms)


# ---------------------------------------------------------------------------- inside the tasks


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _lower_each(text: str) -> str:
    """Lower case of every character on its own; one whose lower case is longer stays."""
    return "".join(t if len(t := c.lower()) == 1 else c for c in text)


class Text:
    """Code points of lower-cased texts, their words, and each word's text."""

    def __init__(self, texts: list[str]) -> None:
        # positions stay those of the text
        folded = [t if len(t := x.lower()) == len(x) else _lower_each(x) for x in texts]
        joined = "\n".join(folded) + "\n"
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(t) + 1 for t in folded), np.int64, len(folded))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        edges = np.flatnonzero(np.diff(np.concatenate(
            ([False], _letters()[self.points], [False])).astype(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.joined = joined

    def word(self, i: int) -> str:
        return self.joined[self.starts[i] : self.ends[i]]


def run(automaton: Automaton, text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Verdict and term of every word."""
    table = np.zeros(0x110000, np.uint8 if len(automaton.alphabet) < 255 else np.uint16)
    for c, k in automaton.alphabet.items():
        table[ord(c)] = k
    size = len(text.starts)
    state = np.ones(size, np.int32)
    lengths = text.ends - text.starts
    live = np.arange(size)
    step = 0
    while len(live):
        live = live[lengths[live] > step]
        nxt = automaton.moves[state[live], table[text.points[text.starts[live] + step]]]
        state[live] = nxt
        live = live[nxt != 0]
        step += 1
    return automaton.verdict[state], automaton.term[state]


FEATURES = ("hits", "terms", "density", "strongest")


def features(automaton: Automaton, odds: np.ndarray, how: Settings, texts: list[str]) -> np.ndarray:
    """One row per text: context-weighted sums of its hits."""
    text = Text(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    if not len(text.starts) or len(automaton.moves) < 2:
        return out
    verdict, term = run(automaton, text)
    hit = np.flatnonzero(verdict)
    if not len(hit):
        return out
    of = text.text[hit]
    quotes = np.flatnonzero(np.isin(text.points, [ord(c) for c in _QUOTES]))
    before = np.searchsorted(quotes, text.starts[hit])
    after = np.searchsorted(quotes, text.ends[hit])
    pad = np.concatenate(([-(1 << 40)], quotes, [1 << 40]))
    left, right = pad[before], pad[after + 1]
    begin = np.searchsorted(quotes, text.offsets[of])  # quotation marks before this text
    inside = ((before - begin) % 2 == 1)
    quoted = inside & (text.starts[hit] - left <= how.window_chars) & (
        right - text.ends[hit] <= how.window_chars) & (right < text.offsets[of + 1])
    # other hits of the same text in the window of words
    lo = np.searchsorted(hit, np.maximum(hit - how.window_words, 0))
    hi = np.searchsorted(hit, hit + how.window_words, side="right")
    first = np.searchsorted(of, of)
    last = np.searchsorted(of, of, side="right")
    near = np.minimum(hi, last) - np.maximum(lo, first) - 1
    weight = np.where(quoted, how.quoted, 1.0) * (1 + 0.25 * np.minimum(near, 2))
    weight = weight * np.where(verdict[hit] == 1, 1.0, how.misspelled)
    n = len(texts)
    total = np.bincount(of, weights=weight, minlength=n)
    out[:, 0] = np.log1p(total)
    pairs = np.unique(np.stack((of, term[hit])), axis=1)
    out[:, 1] = np.log1p(np.bincount(pairs[0], minlength=n))
    words = np.bincount(text.text, minlength=n)
    out[:, 2] = np.sqrt(total / (words + 20))
    top = np.zeros(n)
    np.maximum.at(top, of, odds[term[hit]] * np.minimum(weight, 1))
    out[:, 3] = top / 4
    return out


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _scored(shared):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _groups(texts):
                x = features(m["automaton"], m["odds"], m["how"], texts[a:b])
                z = x @ m["weights"] + m["bias"]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"),
                     pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                    ["doc_id", "held_out", "score"])

    return go


def _candidates(how: Settings):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms: list[str] = []
            words_of: list[str | None] = []
            marks: list[int] = []
            toxic = batch.column("toxic").to_pylist()
            for mark, value in zip(toxic, batch.column("text").to_pylist(), strict=True):
                text = Text([value])
                for w in {text.word(i) for i in range(len(text.starts))}:
                    if not 3 <= len(w) <= 40:
                        continue
                    terms.append(w)
                    words_of.append(None)
                    marks.append(mark)
                    for n in how.stem_lengths:
                        if len(w) > n:
                            terms.append(w[:n])
                            words_of.append(w)
                            marks.append(mark)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(words_of, pa.string()),
                 pa.array(marks, pa.int64())], ["term", "word", "toxic"])

    return go


def _sampled_features(shared):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _groups(texts):
                x = features(m["automaton"], m["odds"], m["how"], texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(a, b - a),
                     pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])

    return go


# --------------------------------------------------------------------------------- learning


def learn_lexicon(sample: DataFrame, totals: tuple[int, int], how: Settings) -> Lexicon:
    """Words and stems far more frequent in toxic texts of the sample (toxic, text)."""
    rows = sample.mapInArrow(_candidates(how), "term string, word string, toxic long")
    # distinct texts per term are counted as distinct words per text and term: a stem that several
    # words of one text share counts once for each, which only favours stems
    counts = rows.groupBy("term", "word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    both = counts.groupBy("term", F.col("word").isNotNull().alias("stem")).agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.max("bad").alias("most"),
        F.count("*").alias("kinds"))
    bad, good = max(1, totals[0]), max(1, totals[1])
    odds = F.log((F.col("bad") + 0.5) / bad) - F.log((F.col("good") + 0.5) / good)
    # the bound keeps the strongest; twice as many are read because stems replace their words
    least = max(how.least_texts, how.least_share * bad)
    kept = both.where(F.col("bad") >= least).withColumn("odds", odds).where(
        F.col("odds") >= how.least_odds
    ).orderBy(F.desc(F.sqrt("bad") * F.col("odds")), "term", "stem").limit(
        10 * how.most_terms).toArrow().to_pandas()
    stems = kept[kept["stem"] & (kept["kinds"] >= 5) & (kept["most"] < 0.6 * kept["bad"])]
    support = dict(zip(stems["term"], stems["bad"], strict=True))
    longer: dict[str, int] = defaultdict(int)
    for term, n in support.items():
        longer[term[:-1]] = max(longer[term[:-1]], n)
    out = Lexicon()
    for row in stems.itertuples():
        if longer[row.term] < 0.85 * row.bad and not any(row.term.startswith(s) for s in out.stems):
            out.stems.append(row.term)
            out.odds[row.term] = float(row.odds)
    for row in kept[~kept["stem"]].itertuples():
        if not row.term.startswith(tuple(out.stems) or ("\0",)):
            out.words.append(row.term)
            out.odds[row.term] = float(row.odds)
    out.stems = out.stems[: how.most_terms // 2]
    out.words = out.words[: how.most_terms - len(out.stems)]
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0,
             rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps; the intercept is not shrunk."""
    design = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(design.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + shrink * w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(shrink)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, labels: DataFrame, how: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score.  Runs jobs that fit the model.

    Rows whose crc32(doc_id as text) mod 4 is 2 are held out of all learning.  Defined results: a
    null or empty text has no hits and gets the score of a text without any; a null doc_id is not
    held out and never labelled; several labels of one document count as toxic if any is; without
    toxic or clean training rows every score is the base rate; repeated rows each get the same
    score; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         text_or_empty().alias("text")).withColumn("held_out", held)
    known = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    known = known.where(~held)
    bad, good = known.agg(F.coalesce(F.sum("toxic"), F.lit(0)),
                          F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    order = F.xxhash64("doc_id", F.lit(9))
    ids = known.where("toxic = 1").orderBy(order).limit(how.toxic_rows).union(
        known.where("toxic = 0").orderBy(order).limit(how.clean_rows))
    # at most toxic_rows + clean_rows ids: a broadcast of bounded size
    sample = source.join(F.broadcast(ids), "doc_id").select("toxic", "text")
    taken = (min(bad, how.toxic_rows), min(good, how.clean_rows))
    lexicon = learn_lexicon(sample, taken, how)
    automaton = build(lexicon, how)
    odds = np.array([lexicon.odds[t] for t in automaton.terms] or [0.0])
    model = {"automaton": automaton, "odds": odds, "how": how}
    seen = sample.mapInArrow(_sampled_features(spark.sparkContext.broadcast(model)),
                             "toxic long, x array<double>").toArrow().to_pandas()
    base = np.log((bad + 0.5) / (good + 0.5))
    weights, bias = np.zeros(len(FEATURES)), float(base)
    if len(seen) and bad and good:
        x = np.stack(seen["x"].to_numpy())
        y = seen["toxic"].to_numpy(float)
        # back from the sample's mixture to that of all labelled rows
        weight = np.where(y == 1, bad / taken[0], good / taken[1])
        order_ = np.lexsort(np.column_stack((x, y)).T)  # sums in a fixed order
        weights, bias = logistic(x[order_], y[order_], weight[order_] / weight.mean())
    shared = spark.sparkContext.broadcast({**model, "weights": weights, "bias": bias})
    return source.select("doc_id", "text", "held_out").mapInArrow(
        _scored(shared), "doc_id long, held_out boolean, score double")

