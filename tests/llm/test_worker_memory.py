"""What operators leave to each other in a Python worker, and hold of a block at once."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tallygate.llm import bpe, byte_bpe, common, gram_exchange, jaccard_join
from tallygate.llm.queries import tokenizer_path


def _peak(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def _table(rows, words, trained):
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 90_000, words))) for _ in range(rows)]
    return pa.table({"text": texts, "trained": trained})


def test_the_exchange_makes_room():
    bpe.splitter(tokenizer_path())
    assert bpe.splitter.cache_info().currsize == 1
    assert list(gram_exchange._ask(gram_exchange._pair_message, 4)(iter([]))) == []
    assert bpe.splitter.cache_info().currsize == byte_bpe.encoder.cache_info().currsize == 0


def test_a_block_and_its_scores_hold_few_arrays():
    rows, words, owners = 500, 4000, 3
    n = rows * (words + 1)
    table = _table(rows, words, [False] * rows)
    gram_exchange._pair_message("b", table, owners)  # tables that stay are made once
    sent, peak = _peak(lambda: gram_exchange._pair_message("b", table, owners))
    assert peak < 64 * n
    b = gram_exchange.Block(table)
    found = {("words", o): gram_exchange._pack(*np.ones((gram_exchange.FACTS, y - x), np.int64))
             for o, x, y in gram_exchange._ranges(b.words, owners)}
    found |= {("pairs", o): gram_exchange._pack(np.ones(y - x, np.int64))
              for o, x, y in gram_exchange._ranges(b.pairs, owners)}
    model = {"d1": (0.5, 0.6, 0.7), "d2": (0.5, 0.6, 0.7), "total": n, "base": 1e-9}
    carried = {"row_key": range(rows), "doc_id": range(rows), "lang": ["en"] * rows,
               "held_out": [False] * rows}
    full = pa.table({**{k: list(v) for k, v in carried.items()}, "text": table["text"]})
    del b
    out, peak = _peak(lambda: gram_exchange._scored(full, found, owners, model))
    assert peak < 60 * n
    assert out.column("n_words").to_pylist() == [words] * rows
    assert np.allclose(out.column("log_perplexity"), out.column("log_perplexity")[0].as_py(),
                       rtol=0.01)


def test_the_join_moves_small_batches(spark, make_docs, monkeypatch):
    name, seen, roots = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard_join._roots
    before = spark.conf.get(name, None)

    def run(*args):
        seen.append(spark.conf.get(name))
        return roots(*args)

    monkeypatch.setattr(jaccard_join, "_roots", run)
    text = " ".join(f"w{i}" for i in range(80))
    rows = jaccard_join.jaccard_components(make_docs([text, text + " z", "other"])).collect()
    assert sorted(r.component_id for r in rows) == [0, 0, 2]
    assert seen == [str(common.BATCH_BYTES)] and spark.conf.get(name, None) == before
