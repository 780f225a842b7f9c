"""Packing: every id in one piece, limits kept, little padding."""

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallygate.llm import byte_bpe, packing
from tallygate.llm.byte_bpe import Encoder, encoder
from tallygate.llm.packing import Example, Limits, Pool

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n", "a", "  two  spaces ", "tab\tand\nline \n break", "it's we'll don't I'LL",
    "digits 123 4567", "Ünïcödé für ñandú 漢字 かな", "emoji 👩‍👩‍👧 end", "<|endoftext|>", "x <|endoftext|>y <|end",
    " no-break space\x1cunit\x85next ", "word " * 3000, "x" * 5000, "same text", "same text",
    "trailing space ", " leading", "a b", "a  b", "a \tb", "​zero width", "'s 's x's '''s",
]


@lru_cache
def _tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_equals_the_library(sf_docs):
    texts = [t or "" for t in TEXTS] + [r["text"] or "" for r in sf_docs.select("text").collect()]
    expected = [e.ids for e in _tokenizer().encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(PATH)
    for size in (7, 7, 100_000):  # the second time words are remembered
        for at in range(0, len(texts), size):
            found = encoder.encode(pa.array(["skipped", *texts[at : at + size]])[1:])
            assert [x.tolist() for x in found] == expected[at : at + size]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(" '\n\ts\x1c\x85\xa0\u2003\u3000\u200b<|>a1é漢"), st.characters(codec="utf-8")),
    max_size=40), max_size=8))
def test_encoder_on_any_text(texts):
    expected = [e.ids for e in _tokenizer().encode_batch(texts, add_special_tokens=False)]
    found = encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == expected


def test_encoder_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(byte_bpe, "span_hashes", lambda b, s, e: np.zeros(len(s), np.uint64))
    texts = ["one two three two", "two one"]
    expected = [e.ids for e in _tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in Encoder(PATH).encode(pa.array(texts))] == expected


def check(pieces, ids_of, limits):
    """``pieces`` rows against the ids of each document, in any order of equal doc_ids."""
    sequences, covered = {}, {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append(r)
        covered.setdefault(r["doc_id"], []).append(r)
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= limits.tokens and len(rows) <= limits.segments
        assert sum(r["loss_tokens"] for r in rows) <= limits.loss_tokens
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    assert covered.keys() == ids_of.keys()
    for key, rows in covered.items():
        copies = ids_of[key]
        spans = sorted((r["start"], r["length"]) for r in rows)
        counts = Counter()
        for start, length in spans:
            counts.update(range(start, start + length))
        assert counts == Counter(i for ids in copies for i in range(len(ids)))
        for r in rows:
            assert any(
                zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
                == r["ids_crc32"] and len(ids) == r["doc_tokens"] for ids in copies)
    return padding


def test_documents_are_packed_whole(make_docs, sf_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, "no id"), (3, "again")]
    tokenizer = _tokenizer()
    for docs in (make_docs(rows), sf_docs):
        ids_of = {}
        for r in docs.select("doc_id", "text").collect():
            ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
            ids_of.setdefault(r["doc_id"], []).append(ids)
        for limits in (Limits(), Limits(256, 4, 200)):
            pieces = packing.pack_documents(docs, PATH, limits).collect()
            assert check(pieces, ids_of, limits) == 0
            for r in pieces:
                assert r["ids"] in [x[r["start"] : r["start"] + r["length"]]
                                    for x in ids_of[r["doc_id"]]]
    assert packing.pack_documents(make_docs([]), PATH).count() == 0


def test_few_documents_are_cut(sf_docs):
    """Apart from being over a sequence long, at most one piece a sequence is a cut one."""
    pieces = packing.pack_documents(sf_docs.coalesce(1), PATH).collect()
    whole = sum(-(-r["doc_tokens"] // 1024) for r in pieces if r["start"] == 0)
    assert len(pieces) <= whole + len({r["sequence_id"] for r in pieces})


def test_dot_product_prefers_what_is_left():
    """With little loss left and much room, an example that bears little loss is placed next."""
    pool = Pool()
    heavy = Example("heavy", np.zeros(50, np.uint32), np.ones(50, bool))
    light = Example("light", np.zeros(45, np.uint32), np.arange(45) < 2)
    other = Example("other", np.zeros(40, np.uint32), np.arange(40) < 38)
    for e in (light, other, heavy):
        pool.add((e, 0, len(e.ids)))
    placed, total = packing.fill(pool, Limits(100, 10, 52, cut=False))
    assert [e.key for e, _, _ in placed] == ["heavy", "light"] and total == 95
    assert pool.tokens == 40


def test_examples_stay_whole_when_told(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        n = int(rng.integers(1, 120))
        rows.append((i, [int(x) for x in rng.integers(0, 50000, n)],
                     [bool(x) for x in rng.random(n) < rng.random()], int(rng.integers(1, 5))))
    rows += [(1000, [], None, None), (1001, None, None, 2), (1002, [7, 8, 9], None, None)]
    df = spark.createDataFrame(
        rows, "doc_id long, ids array<int>, loss array<boolean>, segments int").coalesce(2)
    limits = Limits(tokens=128, segments=8, loss_tokens=64, cut=False)
    fits = [r for r in rows if r[1] and (sum(r[2]) if r[2] else len(r[1])) <= 64]
    found = packing.pack_examples(df.where(df.doc_id.isin([r[0] for r in fits])), limits).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in fits)
    segments = {r[0]: r[3] or 1 for r in rows}
    by_sequence = {}
    for r in found:
        assert r["start"] == 0 and r["length"] == r["doc_tokens"]
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for group in by_sequence.values():
        assert sum(r["length"] for r in group) <= 128
        assert sum(r["loss_tokens"] for r in group) <= 64
        assert sum(segments[r["doc_id"]] for r in group) <= 8
    lower = max(sum(r["length"] for r in found) / 128, sum(r["loss_tokens"] for r in found) / 64,
                sum(segments[r["doc_id"]] for r in found) / 8)
    assert len(by_sequence) <= 1.25 * lower + 2
    with pytest.raises(Exception, match="may not be cut"):
        packing.pack_examples(spark.createDataFrame(
            [(1, list(range(200)), None, 1)], df.schema), limits).collect()


def test_pool_is_bounded_with_tiny_examples():
    """Sequences are closed by the segment limit although they stay short of the token limit."""
    limits, pool = Limits(1024, 8, 1024), Pool()
    examples = [Example(i, np.zeros(3, np.uint32), np.ones(3, bool)) for i in range(50_000)]
    for e in examples:
        pool.add((e, 0, 3))
    kept = pool.tokens
    found = list(packing.sequences(pool, limits, last=True))
    assert sum(b - a for s in found for _, a, b in s) == kept and not pool.tokens
    assert all(len(s) <= 8 for s in found)
    sizes = {sum(b - a for _, a, b in s) for s in found}
    assert all(x & (x - 1) == 0 for x in sizes)
