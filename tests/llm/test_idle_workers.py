"""What a Python worker still holds when a task has ended, and how much text comes in one batch."""

import inspect

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallygate.llm import bpe, common, gram_exchange, jaccard_join, mixing
from tallygate.llm.queries import tokenizer_path

BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


class _Model:
    value = None


@pytest.mark.parametrize("run", [
    jaccard_join._nodes(5), jaccard_join._signed(jaccard_join.Similarity()), jaccard_join._sets(5),
    jaccard_join._similar(80), mixing._encoded(mixing.Mix()),
    mixing._posteriors(_Model, mixing.Mix()), bpe._requests(tokenizer_path(), 2), bpe._bodies,
    gram_exchange._bodies])
def test_a_task_gives_back_when_it_ends(run, monkeypatch):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))
    assert list(run(iter([]))) == []
    assert seen[-1:] == ["back"]


def test_a_group_gives_back_and_keeps_its_arguments(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))
    run = bpe._assembled(tokenizer_path(), 1)
    assert list(inspect.signature(run).parameters) == ["bodies", "answers"]
    assert inspect.getfullargspec(run).args == ["bodies", "answers"]  # Spark looks here
    empty = pa.table({"block": pa.array([], pa.string()), "body": pa.array([], pa.binary())})
    answers = pa.table({"shard": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())})
    assert run(empty, answers).num_rows == 0 and seen == ["back"]


def _batch_settings(spark, monkeypatch, module):
    """The setting at each write of ``module``."""
    seen, write = {}, module.written

    def spy(df, name, *rest):
        seen[name] = spark.conf.get(BATCHES, None)
        return write(df, name, *rest)

    monkeypatch.setattr(module, "written", spy)
    return seen


def test_texts_of_mixing_join_and_ids_come_in_small_batches(spark, sf_docs, sf_labels, monkeypatch):
    before = spark.conf.get(BATCHES, None)
    seen = {}
    for module in (mixing, jaccard_join, corpus_pipeline):
        seen[module] = _batch_settings(spark, monkeypatch, module)
    docs = sf_docs.limit(60)
    mixing.mix(docs, sf_labels)
    jaccard_join.jaccard_components(docs)
    found = corpus_pipeline.bpe_stage(spark, docs, "")
    assert found.count() == docs.count()
    small = str(common.BATCH_BYTES)
    assert seen[mixing]["posteriors"] == seen[jaccard_join]["nodes"] == small
    assert seen[corpus_pipeline]["ids"] == small
    assert spark.conf.get(BATCHES, None) == before


def test_a_block_names_its_words_by_place():
    texts = ["a b a b c", "", "c a", "b b b"]
    table = pa.table({"text": texts, "trained": [True, True, False, True]})
    b = gram_exchange.Block(table)
    words, _ = gram_exchange._sequences(table)
    assert b.words.tolist() == sorted(set(words.tolist()))
    assert b.before.dtype == b.word.dtype == np.int32  # half of what their hashes take
    keys = gram_exchange._pair_keys(b.words[b.before], b.words[b.word])
    assert keys.tolist() == b.pairs.tolist() == sorted(set(keys.tolist()))
    # start a, a b (twice), b a, b c, c end; start end; start c, c a, a end; start b, b b (twice), b end
    assert b.counts(np.array([True] * 4)).sum() == sum(len(t.split()) + 1 for t in texts)
    assert len(b.pairs) == 12


def test_words_are_asked_without_their_pairs(monkeypatch):
    table = pa.table({"text": ["a b a", "b c"], "trained": [True, True]})
    wanted = gram_exchange._pack(gram_exchange._keys_out(gram_exchange.Block(table).words, 0, 1))
    monkeypatch.setattr(gram_exchange, "Block", None)
    assert gram_exchange._word_message("n", table, 1).column("data").to_pylist() == [wanted]
