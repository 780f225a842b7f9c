"""What the exchange of n-grams holds at once: a block, or an owner's distinct pairs."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallygate.llm import gram_exchange, rice


def _peak_mb(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


@pytest.mark.parametrize("n", [1, 7, rice._SLICE - 1, rice._SLICE, rice._SLICE + 1, 300_000])
def test_coding_takes_bits_apart_by_slices(n):
    values = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
    data, peak = _peak_mb(lambda: rice.encode(values, 64))
    assert peak < 64
    back, peak = _peak_mb(lambda: rice.decode(data))
    assert peak < 64 and np.array_equal(back, values)


def _texts(blocks, words, seed=1):
    rng = np.random.default_rng(seed)
    return [" ".join(map(str, rng.integers(0, 3000, words))) for _ in range(blocks)]


def _sent(texts, trained):
    table = pa.table({"text": texts, "trained": trained})
    return pa.concat_tables([pa.Table.from_batches([x]) for x in gram_exchange._ask(
        gram_exchange._pair_message, 1)(iter(table.to_batches()))])


def test_owner_holds_distinct_pairs_not_all_that_are_sent(monkeypatch):
    monkeypatch.setattr(gram_exchange, "BLOCK_BYTES", 1)
    one = _sent(_texts(1, 20_000), [True])
    # the same pairs from many blocks
    sent = pa.table({"owner": pa.array([0] * 60, pa.int64()),
                     "block": [f"b{i}" for i in range(60)],
                     "data": pa.array(one.column("data").to_pylist() * 60, pa.binary())})
    out, peak = _peak_mb(lambda: gram_exchange._own_pairs(1)(sent))
    assert peak < 48
    found = {k: [r for r in out.to_pylist() if r["kind"] == k] for k in ("pairs", "counts")}
    assert len(found["pairs"]) == 60
    counts = gram_exchange._ints(gram_exchange._unpack(found["pairs"][7]["data"])[0])
    assert counts.min() == 60 and counts.sum() == 60 * 20_001
    assert found["counts"][0]["n"] == [0, 0, 0, 0]


def test_pairs_settle_to_the_same_counts():
    rng = np.random.default_rng(3)
    tally, held = gram_exchange.PairCounts(least=50), {}
    for _ in range(40):
        keys = np.unique(rng.integers(0, 400, 30).astype(np.uint64))
        counts = rng.integers(1, 5, len(keys))
        tally.add(keys, keys + np.uint64(1000), keys + np.uint64(2000), counts)
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            held[k] = held.get(k, 0) + c
    keys, before, word, counts = tally.settle()
    assert keys.tolist() == sorted(held) and counts.tolist() == [held[k] for k in sorted(held)]
    assert np.array_equal(before, keys + np.uint64(1000))
    assert np.array_equal(word, keys + np.uint64(2000))
    assert [len(x) for x in gram_exchange.PairCounts().settle()] == [0, 0, 0, 0]


def test_a_block_is_gone_before_the_next(monkeypatch):
    monkeypatch.setattr(gram_exchange, "BLOCK_BYTES", 3 << 20)
    texts = _texts(32, 100_000)
    ask = gram_exchange._ask(gram_exchange._pair_message, 16)

    def run(n):
        table = pa.table({"text": texts[:n], "trained": [False] * n})
        return sum(1 for _ in ask(iter(table.to_batches())))

    run(7)  # tables that stay are made once
    blocks, one = _peak_mb(lambda: run(7))
    more, five = _peak_mb(lambda: run(32))
    assert (blocks, more) == (1, 5) and five < 1.4 * one


def test_groups_come_in_small_batches(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(name, None)
    monkeypatch.setattr(gram_exchange, "_perplexities", lambda rows: seen.append(
        rows.groupBy().applyInArrow(
            lambda t: pa.table({"n": pa.array([t.column(0).num_chunks], pa.int64())}), "n long"
        ).first().n))
    gram_exchange.perplexities(
        spark.range(100).selectExpr("repeat('a', 1000000) AS d").coalesce(1))
    assert seen[0] >= 10 and spark.conf.get(name, None) == before
