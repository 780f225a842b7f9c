"""Language model, mixing and toxicity: against plain computations, and on held-out labels."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygate.llm import kneser_ney, mixing, toxicity

LABELS = "doc_id long, quality int, toxic int"


class PlainKneserNey:
    """Interpolated modified Kneser-Ney with dictionaries, by its recursive definition."""

    def __init__(self, texts, order, share):
        words = Counter(w for t in texts for w in t.split())
        total = sum(words.values())
        self.vocabulary = {w for w, c in words.items() if c >= share * total}
        self.order, self.size = order, len(self.vocabulary) + 2
        self.spread = math.log(max(1, len(words) - len(self.vocabulary)))
        counts = Counter()
        for t in texts:
            s = self.sequence(t)
            for i in range(order - 1, len(s)):
                counts[tuple(s[i - order + 1 : i + 1])] += 1
        self.levels = {order: counts}
        for k in range(order - 1, 0, -1):
            lower = Counter()
            for g, c in self.levels[k + 1].items():
                lower[g[1:]] += c if k > 1 and g[1] == "<s>" else 1
            self.levels[k] = lower
        self.discounts = {}
        for k, table in self.levels.items():
            n = Counter(table.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i * 0.5 for i in (1, 2, 3)]
            self.discounts[k] = [min(max(x, 0.05 * i), 0.95 * i) for i, x in enumerate(d, 1)]
        self.contexts = defaultdict(list)
        for k, table in self.levels.items():
            for g, c in table.items():
                self.contexts[k, g[:-1]].append(c)

    def sequence(self, text):
        return ["<s>"] * (self.order - 1) + [
            w if w in self.vocabulary else "<unk>" for w in text.split()] + ["</s>"]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / self.size
        d = self.discounts[k]
        below = self.p(gram[1:])
        seen = self.contexts.get((k, gram[:-1]))
        if not seen:
            return below
        total = sum(seen)
        gamma = sum(d[min(c, 3) - 1] for c in seen) / total
        c = self.levels[k].get(gram, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total + gamma * below

    def log_perplexity(self, text):
        s = self.sequence(text)
        n = self.order
        total = sum(math.log(self.p(tuple(s[i - n + 1 : i + 1]))) for i in range(n - 1, len(s)))
        total -= self.spread * s.count("<unk>")
        return -total / (len(text.split()) + 1)


def _prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "and", "to", *[f"w{i}" for i in range(30)]]
    weights = [20, 12, 10, 9, *[1] * 30]
    return [" ".join(rng.choices(words, weights, k=rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("order", [2, 3])
def test_scores_match_plain_kneser_ney(spark, order):
    texts = _prose(1, 60)
    how = kneser_ney.Settings(order=order, vocabulary_share=0.004, hot_share=0.01)
    trusted = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kneser_ney.train(trusted, how)
    plain = PlainKneserNey(texts, order, 0.004)
    asked = [*_prose(2, 20), "zz yy xx", "the", "", "the of the", "the of the"]
    rows = spark.createDataFrame([(i, t, "en", False) for i, t in enumerate(asked)],
                                 "doc_id long, text string, lang string, held_out boolean")
    found = {r.doc_id: r.log_perplexity for r in kneser_ney.score(rows, model, how).collect()}
    for i, t in enumerate(asked):
        assert found[i] == pytest.approx(plain.log_perplexity(t), abs=1e-9), t


@pytest.mark.parametrize("order", [2, 3])
def test_rare_words_keep_their_counts_in_large_texts(spark, order):
    # 120,000 tokens: a word that occurs once is below a hundred-thousandth of them
    texts = ["the of and to " * 10] * 3000 + ["the rare%d word%d of" % (i, i % 7) for i in range(50)]
    how = kneser_ney.Settings(order=order, hot_share=0.01)
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"), how)
    plain = PlainKneserNey(texts, order, 0.0)
    asked = ["the rare3 word3 of", "the rare3 word4 of", "rare3", "the unseen word3", "", "of the of"]
    rows = spark.createDataFrame([(i, t, "en", False) for i, t in enumerate(asked)],
                                 "doc_id long, text string, lang string, held_out boolean")
    found = {r.doc_id: r.log_perplexity for r in kneser_ney.score(rows, model, how).collect()}
    for i, t in enumerate(asked):
        assert found[i] == pytest.approx(plain.log_perplexity(t), abs=1e-9), t
    assert found[0] < found[3]


def _scored_by_exchange(spark, trained, asked):
    from tallygate.llm import gram_exchange

    rows = [(i, i, "en", False, t, i < len(trained)) for i, t in enumerate([*trained, *asked])]
    rows = spark.createDataFrame(rows, "row_key long, doc_id long, lang string, held_out boolean, "
                                 "text string, trained boolean")
    found = {r.doc_id: r for r in gram_exchange.perplexities(rows).collect()}
    assert len(found) == rows.count()
    return found


@pytest.mark.parametrize("block, owner", [(1 << 24, 1 << 25), (300, 1000), (1, 40)])
def test_exchange_matches_plain_kneser_ney(spark, monkeypatch, block, owner):
    from tallygate.llm import gram_exchange

    monkeypatch.setattr(gram_exchange, "BLOCK_BYTES", block)
    monkeypatch.setattr(gram_exchange, "OWNER_BYTES", owner)
    # equal texts, so blocks of one document repeat; long, empty and unseen ones
    texts = [*_prose(1, 60), "the of", "the of", "the of", ""]
    asked = [*_prose(2, 20), "zz yy xx", "the", "", "the of the", "the of the", "of zz " * 500,
             "\u00e9t\u00e9 \u4e2d\u6587", "the of"]
    plain = PlainKneserNey(texts, 2, 0.0)
    found = _scored_by_exchange(spark, texts, asked)
    for i, t in enumerate([*texts, *asked]):
        assert found[i].log_perplexity == pytest.approx(plain.log_perplexity(t), abs=1e-9), t
        assert found[i].n_words == len(t.split())


def test_exchange_matches_the_count_tables(spark, sf_docs, sf_labels):
    from tallygate.llm.marks import id_words, marked

    label = sf_labels.where("quality = 1").select("doc_id")
    rows = marked(sf_docs, "doc_id", [(id_words(label, "doc_id", "trained"), "trained")]).select(
        F.col("doc_id").alias("row_key"), "doc_id", "lang", F.lit(False).alias("held_out"), "text",
        "trained")
    from tallygate.llm import gram_exchange

    how = kneser_ney.Settings()
    tables = kneser_ney.score(rows, kneser_ney.train(rows.where("trained"), how), how).select(
        "doc_id", F.col("log_perplexity").alias("other"))
    found = gram_exchange.perplexities(rows).join(tables, "doc_id")
    worst = found.agg(F.max(F.abs(F.col("log_perplexity") - F.col("other"))), F.count("*")).first()
    assert worst[1] == sf_docs.count() and worst[0] < 1e-9


def test_exchange_without_training_or_rows(spark):
    found = _scored_by_exchange(spark, [], ["the of", ""])
    assert found[0].log_perplexity == pytest.approx(math.log(2))
    assert not _scored_by_exchange(spark, [], [])


def test_probabilities_sum_to_one():
    plain = PlainKneserNey(_prose(3, 40), 2, 0.0)
    words = [*plain.vocabulary, "<unk>", "</s>"]
    for context in ("the", "w3", "<s>"):
        assert sum(plain.p((context, w)) for w in words) == pytest.approx(1)


def test_quality_keeps_trusted_like_text(spark, make_docs):
    texts = _prose(5, 400)
    junk = [" ".join(f"q{i}%%{k}" for k in range(30)) for i in range(20)]
    rows = [*enumerate(texts), *((1000 + i, t) for i, t in enumerate(junk)),
            (2000, None), (2001, ""), (None, texts[0]), (3, texts[3])]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(300)] + [(1001, 0, 0), (None, 1, 0), (5, None, 0)], LABELS)
    how = kneser_ney.Settings(vocabulary_share=0.001)
    found = kneser_ney.quality(make_docs(rows), labels, how).collect()
    assert len(found) == len(rows)
    accepted = {r.doc_id: r.accepted for r in found}
    assert not any(accepted[1000 + i] for i in range(20))
    assert sum(accepted[i] for i in range(400)) > 390
    assert accepted[2000] and accepted[2001]
    assert len({r.log_perplexity for r in found if r.doc_id == 3}) == 1
    empty = kneser_ney.quality(make_docs(rows), labels.where("doc_id < 0"), how)
    assert all(r.accepted for r in empty.collect())
    assert kneser_ney.quality(make_docs([]), labels, how).count() == 0


def test_quality_on_table(sf_docs, sf_labels):
    found = kneser_ney.quality(sf_docs, sf_labels).select("doc_id", "accepted").toPandas()
    truth = found.merge(sf_labels.toPandas(), on="doc_id")
    assert truth[truth.quality == 1].accepted.mean() > 0.97
    assert truth[truth.quality == 0].accepted.mean() < 0.5


# ------------------------------------------------------------------------------- mixing


def test_rates_solve_nonnegative_least_squares(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet((0.3, 0.3, 0.3), 200)
    n = rng.integers(1, 500, 200)
    how = mixing.Mix(targets={"clean": 0.2, "low": 0.5, "toxic": 0.3}, rounds=200, tolerance=1e-9)
    members = spark.createDataFrame(
        [(i, int(k), *map(float, x)) for i, (k, x) in enumerate(zip(n, p, strict=True))],
        "doc_id long, n_tokens long, clean double, low double, toxic double")
    rate = {r.doc_id: r.rate for r in mixing.rates(members, how).collect()}
    r = np.array([rate[i] for i in range(200)])
    assert (r >= 0).all()
    assert ((n / n.sum() * r) @ p) == pytest.approx([0.2, 0.5, 0.3], abs=1e-3)


@pytest.mark.parametrize(("shares", "targets"), [
    ((0.96, 0.039, 0.001), None), ((0.9699, 0.03, 0.0001), None),
    ((0.99, 0.009, 0.001), (0.2, 0.5, 0.3))])
def test_rates_of_rare_domains_reach_their_targets(spark, shares, targets):
    how = mixing.Mix() if targets is None else mixing.Mix(
        targets=dict(zip(mixing.DOMAINS, targets, strict=True)))
    members = spark.createDataFrame(
        [(j, round(s * 1e6), *(float(i == j) for i in range(3))) for j, s in enumerate(shares)],
        "doc_id long, n_tokens long, clean double, low double, toxic double")
    total = {r.doc_id: r.n_tokens * r.rate for r in mixing.rates(members, how).collect()}
    tokens = sum(round(s * 1e6) for s in shares)
    for j, d in enumerate(mixing.DOMAINS):
        assert total[j] / tokens == pytest.approx(how.targets[d], rel=1e-4)


def test_rates_of_targets_out_of_reach(spark):
    schema = "doc_id long, n_tokens long, clean double, low double, toxic double"
    p = [0.8, 0.15, 0.05]
    rows = mixing.rates(spark.createDataFrame([(1, 3, *p), (2, 5, *p)], schema), mixing.Mix()).collect()
    best = np.dot(p, [0.96, 0.03, 0.01]) / np.dot(p, p)
    assert [r.rate for r in rows] == pytest.approx([best, best], abs=1e-6)
    other = spark.createDataFrame([(1, 3, 0.3, 0.3, 0.4), (2, 5, 0.9, 0.05, 0.05)], schema)
    with pytest.warns(RuntimeWarning, match="not optimal"):
        mixing.rates(other, mixing.Mix(rounds=0)).collect()


def test_rates_without_tokens(spark):
    schema = "doc_id long, n_tokens long, clean double, low double, toxic double"
    none = spark.createDataFrame([(1, 0, 1.0, 0.0, 0.0)], schema)
    assert [r.rate for r in mixing.rates(none, mixing.Mix()).collect()] == [1.0]
    assert mixing.rates(none.where("doc_id > 1"), mixing.Mix()).count() == 0


def test_copies_have_the_expected_number(spark):
    found = spark.range(20_000).select(mixing.copies(F.lit(1.3), F.col("id")).alias("n"))
    assert {r.n for r in found.distinct().collect()} == {1, 2}
    assert found.agg(F.avg("n")).first()[0] == pytest.approx(1.3, abs=0.02)


def test_mix_on_table(sf_docs, sf_labels, make_docs):
    found = mixing.mix(sf_docs, sf_labels).toPandas()
    labels = sf_labels.toPandas().groupby("doc_id").agg({"quality": "min", "toxic": "max"})
    labels.columns = ["is_good", "is_toxic"]
    truth = found.merge(labels, left_on="doc_id", right_index=True)
    clean = truth[(truth.is_good == 1) & (truth.is_toxic == 0)]
    assert (clean.clean > 0.5).mean() > 0.95 and clean.rate.mean() > 1
    assert truth[truth.is_toxic == 1].rate.mean() < 0.5
    odd = mixing.mix(make_docs([(None, None), (1, ""), (2, "x"), (2, "x")]), sf_labels).collect()
    assert sorted(r.n_tokens for r in odd) == [0, 0, 1, 1]
    assert len({r.rate for r in odd if r.doc_id == 2}) == 1
    assert mixing.mix(make_docs([]), sf_labels).count() == 0


# ------------------------------------------------------------------------------ toxicity


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(3)
    how = toxicity.Settings()
    words = ["idiot", "clown", "loser", "scum", "pathetic", "losers"]
    lexicon = toxicity.Lexicon(words, ["lowei"], dict.fromkeys([*words, "lowei"], 8.0))
    automaton = toxicity.build(lexicon, how)
    tried = list(words)
    for _ in range(3000):
        w = list(rng.choice([*words, "loweixyz"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w) + 1)
            kind = rng.randrange(3)
            w[at : at + (kind != 0)] = [rng.choice("abcdiloswz")] if kind != 1 else []
        if w:
            tried.append("".join(w))
    text = toxicity.Text([" ".join(tried)])
    verdict, _ = toxicity.run(automaton, text)
    for w, v in zip(tried, verdict.tolist(), strict=True):
        if w in words or w.startswith("lowei"):
            assert v == 1, w
        else:
            near = any(len(t) >= how.fuzzy_letters and _distance(w, t) <= 1 for t in words)
            assert v == (2 if near else 0), w


def test_folding_is_by_character():
    """A character whose lower case is longer does not keep the others from being folded."""
    text = toxicity.Text(["you IDIOT go", "you IDIOT go \u0130"])
    assert [text.word(i) for i in range(3)] == ["you", "idiot", "go"]
    assert [text.word(i) for i in range(3, 6)] == ["you", "idiot", "go"]
    assert text.points[text.offsets[2] - 2] == ord("\u0130")


def test_context_tells_quotation_from_abuse():
    how = toxicity.Settings()
    lexicon = toxicity.Lexicon(["idiot"], [], {"idiot": 8.0})
    automaton = toxicity.build(lexicon, how)
    score = toxicity.features(automaton, np.array([8.0]), how, [
        "you idiot go away", 'he said "you idiot" once', "you idi0t, ediot", "", "nothing",
        "he said “nothing”, idiot"])[:, 0]
    assert score[1] < score[0] and 0 < score[2] and score[3] == score[4] == 0
    assert score[5] == pytest.approx(score[0])


def test_toxicity_on_planted_texts(spark, make_docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(40)]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(40), rng.choice(["moron", "trash", "stupid"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "you moron"), (5002, "W1 MORON stupid " * 40_000),
             (5002, "W1 MORON stupid " * 40_000)]
    labels += [(None, 1, 1), (7, 1, None), (3, 1, 0)]
    found = toxicity.score(make_docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows)
    score = {r.doc_id: r.score for r in found}
    assert all((score[i] >= 0.3) == (i % 10 == 0) for i in range(600))
    assert score[5000] == score[5001] < 0.3 <= score[5002] and score[None] >= 0.3
    assert not next(r for r in found if r.doc_id is None).held_out
    unlabelled = toxicity.score(make_docs(rows[:20]), spark.createDataFrame([], LABELS))
    assert len({r.score for r in unlabelled.collect()}) == 1
    assert toxicity.score(make_docs([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_labels_of_held_out_rows_play_no_part(spark, sf_docs, sf_labels):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    turned = sf_labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.score(sf_docs, sf_labels).orderBy("doc_id").collect()
    assert a == toxicity.score(sf_docs, turned).orderBy("doc_id").collect()
