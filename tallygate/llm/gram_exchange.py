"""Counting and scoring of a bigram Kneser-Ney model by an exchange of distinct n-grams.

No row stands for an occurrence of an n-gram; only blocks of documents and ranges of hashes talk.

1. A block of documents sends its distinct word pairs to the owners of ranges of the pair's hash.
   Pairs of its training documents go with their counts, as sorted words and sorted pairs of their
   places; of all others the hash is enough.  Both are Golomb-Rice coded.  A pair goes once per
   block however often it is repeated, and the followers of one frequent word spread over all
   owners.
2. An owner adds the counts and answers each block with the count of each of its pairs.  It hands
   on, per word, what the pairs say of it as a context (total, pairs seen once, twice, more) and as
   a continuation (different words before it).
3. Owners of ranges of words add that up and answer each block for its distinct words.
4. Blocks meet their answers and score their documents from the model's definition.

What is held at once is a block (``BLOCK_BYTES`` of text), or an owner's coded messages and its
distinct counted pairs; the number of both follows the size of the input.  The model as a whole is nowhere.  Blocks are named by a digest of
their texts; both scans form the same ones, and a block without an answer fails the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm import rice
from tallygate.llm.common import (
    chunks, drop, give_back, gives_back, make_room, release, small_batches, texts_of, written,
)

#: Larger blocks repeat fewer pairs and take more of a task's memory.
BLOCK_BYTES = 14 << 20
#: Text bytes behind one owner of pairs; pairs sent by all blocks come to a fraction of that.
OWNER_BYTES = 48 << 20
#: The facts of a word: different words before it; as a context: tokens, pairs seen 1, 2, 3+ times.
FACTS = 5

_MESSAGE = "owner long, block string, data binary"
_CARRIED = ["row_key", "doc_id", "lang", "held_out"]


# ---------------------------------------------------------------------------------- coding


def _pack(*arrays: bytes | np.ndarray) -> bytes:
    """Byte strings and arrays of non-negative integers as one; arrays by planes of bytes."""
    parts = []
    for x in arrays:
        if isinstance(x, np.ndarray):
            planes = np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8).T
            x = zstandard.ZstdCompressor(level=3).compress(planes.tobytes())
        parts.append(x)
    head = np.array([len(parts), *map(len, parts)], np.uint64).tobytes()
    return head + b"".join(parts)


def _unpack(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.uint64, 1)[0])
    sizes = np.frombuffer(data, np.uint64, n, 8).astype(np.int64)
    ends = np.cumsum(sizes) + 8 * (n + 1)
    return [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def _ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()


def _ranges(values: np.ndarray, owners: int) -> list[tuple[int, int, int]]:
    """(owner, start, end) of the ranges of sorted unsigned hashes that hold any."""
    edges = np.array([(i << 64) // owners for i in range(1, owners)], np.uint64)
    at = np.concatenate(([0], np.searchsorted(values, edges), [len(values)])).tolist()
    return [(o, a, b) for o, (a, b) in enumerate(zip(at, at[1:])) if b > a]


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    from tallygate.llm.kneser_ney import gram_keys

    return gram_keys([word, before]).view(np.uint64)


def _range(owner: int, owners: int) -> tuple[np.uint64, int]:
    """Where an owner's range of hashes begins, and the bits of a hash counted from there."""
    return np.uint64((owner << 64) // owners), 64 - (owners.bit_length() - 1)


def _keys_out(keys: np.ndarray, owner: int, owners: int) -> bytes:
    start, bits = _range(owner, owners)
    return rice.encode(keys - start, bits)


def _keys_in(data: bytes, owner: int, owners: int) -> np.ndarray:
    return rice.decode(data) + _range(owner, owners)[0]


def _pairs_out(before: np.ndarray, word: np.ndarray, counts: np.ndarray) -> list:
    words, at = np.unique(np.concatenate((before, word)), return_inverse=True)
    size = np.uint64(len(words))
    codes = at[: len(word)].astype(np.uint64) * size + at[len(word) :].astype(np.uint64)
    order = np.argsort(codes)
    bits = max(1, (len(words) ** 2 - 1).bit_length())
    return [rice.encode(words, 64), rice.encode(codes[order], bits), counts[order]]


def _pairs_in(words: bytes, codes: bytes, counts: bytes) -> tuple[np.ndarray, ...]:
    """(before, word, count, key)."""
    words, codes = rice.decode(words), rice.decode(codes)
    size = np.uint64(max(1, len(words)))
    before, word = words[codes // size], words[codes % size]
    return before, word, _ints(counts), _pair_keys(before, word)


# ---------------------------------------------------------------------------------- blocks


def _texts(rows: pa.Table | pa.RecordBatch, step: int = 256) -> Iterator[list[bytes]]:
    """The texts a few rows at a time: as Python objects they are held twice."""
    for start in range(0, rows.num_rows, step):
        yield texts_of(rows.slice(start, step).column("text"))


def _sequences(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with a start and an end for each document, and its number of words."""
    from tallygate.llm.kneser_ney import Sequences

    ids, n_words = [], []
    for texts in _texts(table):
        for a, b in chunks(texts):
            s = Sequences(texts[a:b], None, 2)
            ids.append(s.ids)
            n_words.append(s.sizes)
    return np.concatenate(ids).view(np.uint64), np.concatenate(n_words)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with index (of any that are equal) and inverse, an eighth of the hashes at a time."""
    to = np.empty(len(keys), np.int32)
    found, places, size = [], [], 0
    for r in range(8):
        low, high = np.uint64(r << 61), np.uint64(((r + 1) << 61) - 1)
        mine = np.flatnonzero((keys >= low) & (keys <= high)).astype(np.int32)
        if len(mine):
            part = keys[mine]
            order = np.argsort(part)
            part, mine = part[order], mine[order]
            first = np.concatenate(([True], part[1:] != part[:-1]))
            to[mine] = np.cumsum(first, dtype=np.int32) + np.int32(size - 1)
            found.append(part[first])
            places.append(mine[first])
            size += len(found[-1])
            del part, order, first
    del mine
    return np.concatenate(found), np.concatenate(places), to


class Block:
    """Consecutive documents: their distinct pairs and words, each in the order of its hash.

    A pair names its two words by their places among the distinct ones.
    """

    def __init__(self, table: pa.Table) -> None:
        ids, self.n_words = _sequences(table)
        self.words, _, ids = _distinct(ids)
        # every document has a start in front, which is no word
        at = self._docs()
        at += np.arange(1, len(at) + 1, dtype=np.int32)
        keys = np.empty(len(at), np.uint64)
        for a in range(0, len(at), 1 << 17):
            part = at[a : a + (1 << 17)]
            keys[a : a + (1 << 17)] = _pair_keys(self.words[ids[part - 1]], self.words[ids[part]])
        self.pairs, places, self.pair = _distinct(keys)
        del keys
        at = at[places]
        del places
        self.before, self.word = ids[at - 1], ids[at]
        del ids, at
        self.doc = self._docs()

    def _docs(self) -> np.ndarray:
        """The document of each pair that stands in the texts."""
        return np.repeat(np.arange(len(self.n_words), dtype=np.int32), self.n_words + 1)

    def counts(self, trained: np.ndarray) -> np.ndarray:
        """How often each distinct pair stands in the documents marked."""
        return np.bincount(self.pair[trained[self.doc]], minlength=len(self.pairs))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    held, digest, size = [], hashlib.blake2b(digest_size=16), 0
    for batch in batches:
        trained = iter(batch.column("trained").to_pylist())
        start = row = 0
        for texts in _texts(batch):
            for t in texts:
                digest.update(b"%d:%d:" % (next(trained), len(t)))
                digest.update(t)
                size += len(t) + 1
                row += 1
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(start, row - start))
                    yield digest.hexdigest(), pa.Table.from_batches(held)
                    held, digest, size = [], hashlib.blake2b(digest_size=16), 0
                    start = row
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield digest.hexdigest(), pa.Table.from_batches(held)


def _messages(block: str, sent: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([o for o, _ in sent], pa.int64()), pa.array([block] * len(sent), pa.string()),
         pa.array([d for _, d in sent], pa.binary())], ["owner", "block", "data"])


def _pair_message(name: str, table: pa.Table, owners: int) -> pa.RecordBatch:
    b = Block(table)
    counts = b.counts(table.column("trained").to_numpy())
    sent = []
    for o, x, y in _ranges(b.pairs, owners):
        c = counts[x:y]
        t = c > 0
        sent.append((o, _pack(_keys_out(b.pairs[x:y][~t], o, owners),
                              *_pairs_out(b.words[b.before[x:y][t]], b.words[b.word[x:y][t]],
                                          c[t]))))
    return _messages(name, sent)


def _word_message(name: str, table: pa.Table, owners: int) -> pa.RecordBatch:
    words, _ = _sequences(table)
    words.sort()
    words = words[np.concatenate(([True], words[1:] != words[:-1]))]
    return _messages(name, [(o, _pack(_keys_out(words[x:y], o, owners)))
                            for o, x, y in _ranges(words, owners)])


def _ask(message, owners: int):
    """``message`` of each block; what one is made of is gone before the next block is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for name, table in _blocks(batches):
            yield message(name, table, owners)
            give_back()

    return run


@gives_back
def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, table in _blocks(batches):
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table.combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["block", "body"])


# ---------------------------------------------------------------------------------- owners


def _sums(keys: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the column sums of their rows."""
    out, to = np.unique(keys, return_inverse=True)
    total = np.zeros((len(out), facts.shape[1]), np.int64)
    for j in range(facts.shape[1]):
        total[:, j] = np.bincount(to, weights=facts[:, j], minlength=len(out))
    return out, total


def _looked_up(asked: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of ``values`` by sorted key, zero for keys that are not there."""
    at = np.searchsorted(keys, asked)
    known = at < len(keys)
    known[known] = keys[at[known]] == asked[known]
    out = np.zeros((len(asked), *values.shape[1:]), values.dtype)
    out[known] = values[at[known]]
    return out


_OWNED = "kind string, owner long, block string, source long, data binary, n array<long>"
_OWNED_ARROW = pa.schema([
    ("kind", pa.string()), ("owner", pa.int64()), ("block", pa.string()), ("source", pa.int64()),
    ("data", pa.binary()), ("n", pa.list_(pa.int64()))])


def _owned(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _OWNED_ARROW, strict=True)],
        schema=_OWNED_ARROW)


def _received(rows: pa.Table) -> Iterator[tuple[str | None, memoryview]]:
    """Sender and message, one after the other and without a copy."""
    for batch in rows.select(["block", "data"]).to_batches():
        for block, data in zip(batch.column("block"), batch.column("data"), strict=True):
            yield block.as_py(), memoryview(data.as_buffer())


class PairCounts:
    """Distinct pairs in the order of their keys, with added counts.

    What is added waits until it is half as much as the distinct pairs, so that what is held follows
    these and not the pairs sent.
    """

    def __init__(self, least: int = 1 << 18) -> None:
        self.least, self.waiting, self.size = least, [], 0
        self.held = tuple(np.empty(0, np.uint64) for _ in range(3)) + (np.empty(0, np.int64),)

    def add(self, keys: np.ndarray, before: np.ndarray, word: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, before, word, counts))
        self.size += len(keys)
        if self.size > max(self.least, len(self.held[0]) // 2):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """(key, before, word, count)."""
        if self.waiting:
            columns = list(zip(self.held, *self.waiting, strict=True))
            self.held, self.waiting, self.size = (), [], 0
            keys, before, word, counts = (np.concatenate(columns.pop(0)) for _ in range(4))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([len(keys) > 0], keys[1:] != keys[:-1])))
            keys, at = keys[first], order[first]
            counts = np.add.reduceat(counts[order], first) if len(first) else counts
            del order, first
            before = before[at]
            self.held = keys, before, word[at], counts
        return self.held


def _word_facts(before: np.ndarray, word: np.ndarray, counts: np.ndarray):
    """Sorted words of distinct pairs, and their facts: a column each."""
    as_word, kinds = np.unique(word, return_counts=True)
    contexts, to = np.unique(before, return_inverse=True)
    words = np.union1d(as_word, contexts)
    facts = np.zeros((FACTS, len(words)), np.int64)
    facts[0, np.searchsorted(words, as_word)] = kinds
    del as_word, kinds
    at = np.searchsorted(words, contexts)
    facts[1, at] = np.bincount(to, weights=counts, minlength=len(at))
    for j, of in ((2, counts == 1), (3, counts == 2), (4, counts > 2)):
        facts[j, at] = np.bincount(to[of], minlength=len(at))
    return words, facts


def _own_pairs(owners: int):
    """Answers to the blocks, facts for the owners of words, and how many pairs have 1 to 4.

    Messages are read twice, one at a time: for the counts, then for the answers.
    """

    @gives_back
    def run(rows: pa.Table) -> pa.Table:
        make_room()
        me = rows.column("owner")[0].as_py()
        tally = PairCounts()
        for _, data in _received(rows):
            before, word, counts, key = _pairs_in(*_unpack(data)[1:])
            tally.add(key, before, word, counts)
        keys, before, word, c = tally.settle()
        del tally
        words, facts = _word_facts(before, word, c)
        del before, word
        out = []
        for o, x, y in _ranges(words, owners):
            out.append(("facts", o, None, me, _pack(
                _keys_out(words[x:y], o, owners), *facts[:, x:y]), None))
        del words, facts
        answered = set()
        for block, data in _received(rows):
            # equal blocks of several tasks all count, and get one answer
            if block not in answered:
                answered.add(block)
                asked, *pairs = _unpack(data)
                mine = np.sort(np.concatenate((_keys_in(asked, me, owners), _pairs_in(*pairs)[3])))
                out.append(("pairs", None, block, me, _pack(_looked_up(mine, keys, c)), None))
        out.append(("counts", None, None, me, None, [int((c == i).sum()) for i in (1, 2, 3, 4)]))
        return _owned(out)

    return run


def _own_words(end: int, owners: int):
    """Answers to the blocks; words with 1 to 4 words before, words and sum of all, but the end."""

    @gives_back
    def run(rows: pa.Table) -> pa.Table:
        make_room()
        me = rows.column("owner")[0].as_py()
        keys, parts = [np.empty(0, np.uint64)], [np.zeros((0, FACTS), np.int64)]
        for block, data in _received(rows):
            if block is None:
                words, *facts = _unpack(data)
                keys.append(_keys_in(words, me, owners))
                parts.append(np.stack([_ints(f) for f in facts], 1))
        keys, parts = np.concatenate(keys), np.concatenate(parts)
        words, facts = _sums(keys, parts)
        del keys, parts
        out, answered = [], {None}
        for block, data in _received(rows):
            if block not in answered:
                answered.add(block)
                asked = _keys_in(_unpack(data)[0], me, owners)
                out.append(
                    ("words", None, block, me, _pack(*_looked_up(asked, words, facts).T), None))
        c = facts[:, 0]
        types = int(((c > 0) & (words != np.uint64(end))).sum())
        out.append(("counts", None, None, me, None,
                    [*[int((c == i).sum()) for i in (1, 2, 3, 4)], int((c > 2).sum()), types,
                     int(c.sum())]))
        return _owned(out)

    return run


# ------------------------------------------------------------------------------------ score


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def _scored(table: pa.Table, found: dict, owners: int, model: dict) -> pa.Table:
    b, table = Block(table), table.select(_CARRIED)  # the texts are read
    c = np.concatenate([_ints(_unpack(found["pairs", o])[0])
                        for o, _, _ in _ranges(b.pairs, owners)])
    facts = np.concatenate([np.stack([_ints(f) for f in _unpack(found["words", o])], 1)
                            for o, _, _ in _ranges(b.words, owners)])
    if len(c) != len(b.pairs) or len(facts) != len(b.words):
        raise ValueError("a block's answers do not fit it")
    del b.pairs
    d1, d2 = model["d1"], model["d2"]
    alone = (facts[:, 0] - _discount(facts[:, 0], d1)) / model["total"] + model["base"]
    total = np.maximum(facts[:, 1], 1)
    gamma = np.where(facts[:, 1] > 0, facts[:, 2:] @ np.array(d2) / total, 1.0)
    del facts
    p = np.empty(len(c))
    for a in range(0, len(c), 1 << 17):
        x = slice(a, a + (1 << 17))
        h = b.before[x]
        q = alone[b.word[x]]
        q *= gamma[h]
        q += (c[x] - _discount(c[x], d2)) / total[h]
        p[x] = np.log(q)
    del c, alone, total, gamma
    sums = np.empty(table.num_rows)
    edges = np.concatenate(([0], np.cumsum(b.n_words + 1))).tolist()
    for a in range(0, table.num_rows, 256):
        e = min(a + 256, table.num_rows)
        x = slice(edges[a], edges[e])
        sums[a:e] = np.bincount(b.doc[x] - np.int32(a), weights=p[b.pair[x]], minlength=e - a)
    return table.append_column(
        "n_words", pa.array(b.n_words.astype(np.int64))).append_column(
        "log_perplexity", pa.array(-sums / (b.n_words + 1)))


def _score(owners: int, model: dict):
    @gives_back
    def run(bodies: pa.Table, answers: pa.Table) -> pa.Table:
        make_room()
        found = {(k.as_py(), s.as_py()): memoryview(d.as_buffer()) for k, s, d in zip(
            *[answers.column(c) for c in ("kind", "source", "data")], strict=True)}
        parts = [_scored(pa.ipc.open_stream(body.as_buffer()).read_all(), found, owners, model)
                 for body in bodies.column("body")]
        schema = pa.schema([("row_key", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()),
                            ("held_out", pa.bool_()), ("n_words", pa.int64()),
                            ("log_perplexity", pa.float64())])
        return pa.concat_tables(parts).cast(schema) if parts else schema.empty_table()

    return run


def perplexities(rows: DataFrame) -> DataFrame:
    """(row_key, doc_id, lang, held_out, n_words, log_perplexity): one row per row, written.

    ``rows`` has row_key, doc_id, lang, held_out, text (not null) and trained (boolean).  Runs jobs.
    Without training documents every word has the same probability.
    """
    with small_batches(rows.sparkSession):
        return _perplexities(rows)


def _perplexities(rows: DataFrame) -> DataFrame:
    from tallygate.llm.kneser_ney import END, discounts_of

    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    owners = max(1, -(-size // OWNER_BYTES))
    texts = rows.select("text", "trained")
    # a number of its own keeps small coded groups apart that would be merged by their size
    pairs = written(
        texts.mapInArrow(_ask(_pair_message, owners), _MESSAGE).repartition(owners, "owner")
        .groupBy("owner").applyInArrow(_own_pairs(owners), _OWNED), "pairs")
    release(rows.sparkSession)  # the messages of the pairs, before those of the words are written
    facts = pairs.where("kind = 'facts'").select("owner", "block", "data")
    words = written(
        facts.union(texts.mapInArrow(_ask(_word_message, owners), _MESSAGE)).repartition(owners, "owner")
        .groupBy("owner").applyInArrow(_own_words(END % (1 << 64), owners), _OWNED), "words")

    def added(table: DataFrame, length: int) -> list[int]:
        one = table.where("kind = 'counts'").agg(
            *[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(length)])
        return list(one.first())

    release(rows.sparkSession)  # the messages of the words, before the texts are dealt by block
    d2 = discounts_of(*added(pairs, 4))
    *counts, more, types, total = added(words, 7)
    d1 = discounts_of(*counts)
    mass = counts[0] * d1[0] + counts[1] * d1[1] + more * d1[2]
    # the class of unknown words and the end are two types more
    model = {"d1": d1, "d2": d2, "total": max(total, 1),
             "base": (mass / total if total else 1.0) / (types + 2)}
    answers = pairs.where("kind = 'pairs'").union(words.where("kind = 'words'")).select(
        "kind", "block", "source", "data")
    bodies = rows.select(*_CARRIED, "text", "trained").mapInArrow(
        _bodies, "block string, body binary")
    scores = written(bodies.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(owners, model), "row_key long, doc_id long, lang string, held_out boolean, "
        "n_words long, log_perplexity double"), "perplexity")
    drop(pairs, words)
    return scores
