"""Exact copies, the similarity join, components and the coder behind the exchange."""

import hashlib
import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

from tallygate.llm import jaccard_join, rice
from tallygate.llm.components import components
from tallygate.llm.exact_dedup import exact_groups
from tallygate.llm.jaccard_join import Similarity, jaccard_components, shingle_sets


@pytest.mark.parametrize("bits", [1, 8, 40, 64])
def test_rice_round_trip(bits):
    rng = random.Random(bits)
    for n in (0, 1, 2, 300):
        values = np.array(sorted(rng.getrandbits(bits) for _ in range(n)), np.uint64)
        assert (rice.decode(rice.encode(values, bits)) == values).all()


def test_rice_is_small():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 62, 4096, dtype=np.uint64))
    assert len(rice.encode(values, 62)) * 8 / 4096 < 62 - 12 + 2.5


def _expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").encode().lower()]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep,
                    hashlib.sha256((t or "").encode().lower()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups(make_docs, monkeypatch):
    rows = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (None, "abc"),
            (7, "only"), (7, "only"), (8, "x" * 300_000), (9, "X" * 300_000), (None, "alone")]
    assert sorted(map(tuple, exact_groups(make_docs(rows)).collect()), key=repr) == _expected(rows)


def test_exact_groups_of_nothing_and_of_one_text(make_docs):
    assert exact_groups(make_docs([])).count() == 0
    found = exact_groups(make_docs(["same"] * 500)).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(499, 500)}
    assert sum(r.kept for r in found) == 1


def test_exact_groups_on_table(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    assert sorted(map(tuple, exact_groups(sf_docs).collect()), key=repr) == _expected(rows)


def _links(sets, percent):
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        both = len(a & b)
        if a and b and 100 * both >= percent * len(a | b):
            yield i, j


def _roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def _plain_set(text, words):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" ")
    w = [x for part in w for x in part.split("\n") if x]
    if 0 < len(w) < words:
        return {tuple(w)}
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def _near_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 5, 8, 12, 30, 90, 300]))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("how", [Similarity(4, 85), Similarity(5, 80), Similarity(2, 50)])
def test_components_match_brute_force(make_docs, how):
    texts = _near_texts(how.percent, 120) + ["", None, "a", "A", "a b", "A  B\n"]
    sets = [_plain_set(t, how.words) for t in texts]
    roots = _roots(len(texts), _links(sets, how.percent))
    found = {r.doc_id: r for r in jaccard_components(make_docs(texts), how).collect()}
    assert [found[i].component_id for i in range(len(texts))] == roots
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_components_of_odd_rows(make_docs):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(None, "one two three four five"), (3, "one two three four five"), (9, long),
            (9, long), (4, long + " more"), (None, "alone here with nobody else"), (6, None)]
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_components(make_docs(rows)).collect()),
                   key=repr)
    assert found == sorted([(None, 3), (3, 3), (9, 4), (9, 4), (4, 4), (None, None), (6, 6)], key=repr)
    assert jaccard_components(make_docs([])).count() == 0


def test_large_group_makes_linear_pairs(make_docs, monkeypatch):
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join([*base[: i % 190], f"x{i}", *base[i % 190 :]]) for i in range(300)]
    pairs = []
    real = jaccard_join._verified

    def counted(candidates, sets, percent):
        pairs.append(candidates.count())
        return real(candidates, sets, percent)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    found = jaccard_components(make_docs(texts), Similarity(4, 85)).collect()
    assert {r.component_id for r in found} == {0}
    assert sum(pairs) < 15 * len(texts)


def test_signatures_meet_for_every_linked_pair():
    rng = random.Random(4)
    for size in (1, 3, 5, 6, 9, 12, 17, 24, 40, 80, 200, 700):
        for _ in range(20):
            a = [rng.getrandbits(63) for _ in range(size)]
            h = jaccard_join.differences(size, 85)
            b = a[rng.randint(0, min(h, size - 1)) :] if rng.random() < 0.5 else list(a)
            while len(set(a) ^ set(b)) < h and len(b) < size:
                b.append(rng.getrandbits(63))
            x, y = (np.unique(np.array(v, np.uint64)) for v in (a, b))
            both = len(set(a) & set(b))
            if 100 * both >= 85 * len(set(a) | set(b)):
                assert np.intersect1d(jaccard_join.signatures(x, 85),
                                      jaccard_join.signatures(y, 85)).size


def test_components_of_long_chain(spark):
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(60)}
    assert components(links.where("a < 0")).count() == 0


def test_shingles_split_at_ascii_space_only():
    a, b, c = shingle_sets(["a b c".encode(), "A B C".encode(), b"a b c"], 2)
    assert len(a) == 1 and a.tolist() == b.tolist() and len(c) == 2
