"""BPE encoding and decoding through a sharded table of distinct words.

1. Tasks split texts into the tokenizer's words, a block of documents at a time.  A block sends its
   distinct words, compressed, to shards of the word space; a word occurs once per block however
   often it is repeated, so no word is a hot key.
2. A shard merges what it received, encodes each distinct word once, and answers every block with
   the ids of its words in the order they were sent.
3. Blocks meet their answers; ids are put back by the position of each word in its text.  Decoding
   looks every id up in the id-to-piece table, whose size is the vocabulary's.

Blocks are named by a digest of their texts.  Both scans of the documents form the same blocks; if
a scan were ever cut differently, a block would find no answer and the job would fail, not return
wrong ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import gives_back, kept, text_or_empty

#: Text bytes of a block, and text bytes behind one shard; shards follow the size of the input.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20

# The word pattern of the tokenizer file, checked when it is loaded.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters for which plain lower-casing equals the file's normaliser; other texts go through it.
_PLAIN = "\t\n\r" + "".join(
    chr(c) for a, b in ((0x20, 0x7E), (0xA0, 0x24F), (0x2010, 0x2027)) for c in range(a, b + 1))


def _class(kind: str, chars: str) -> str:
    return "".join(map(re.escape, sorted(set(regex.findall(kind, chars)))))


def _words_of(chars: str) -> re.Pattern:
    """PATTERN for texts of these characters, with its classes spelled out for the faster re.

    Only the first and the last alternative can begin with the same character, so the most frequent
    one comes first.
    """
    letters, digits, spaces = (_class(k, chars) for k in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f"[{letters}]+|[{digits}]|'(?:[stmd]|re|ve|ll)|[^{spaces}{letters}{digits}]+")


_ODD = re.compile(f"[^{re.escape(_PLAIN)}]")
_WORDS = _words_of(_PLAIN.lower())
# most texts: classes of ASCII alone are looked up faster
_ASCII_WORDS = _words_of("".join(c for c in _PLAIN.lower() if c.isascii()))


class Splitter:
    """Texts to words as the tokenizer file does it: special tokens, normaliser, word pattern."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        found = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if found != PATTERN or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"not a word-end BPE file of the expected form: {path}")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.is_special = frozenset(special)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.pieces = pa.array([self.tokenizer.id_to_token(i) for i in range(size)], pa.string())

    def words(self, text: str) -> list[str]:
        if self.special is None or "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for part in self.special.split(text):
            out.extend([part] if part in self.is_special else self._plain(part))
        return out

    def _plain(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return (_ASCII_WORDS if text.isascii() else _WORDS).findall(text.lower())
        text = self.tokenizer.normalizer.normalize_str(text)
        spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def encode(self, words: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [e.ids for e in found]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """Texts of consecutive lists of ids."""
        return pc.binary_join(pa.ListArray.from_arrays(
            pa.array(edges.astype(np.int32)), self.pieces.take(pa.array(ids))), " ")


@kept
def splitter(path: str) -> Splitter:
    return Splitter(path)


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _joined(words: list[str]) -> bytes:
    # words hold no white space, so a line break separates them
    return "\n".join(words).encode()


def _shard(words: list[str], shards: int) -> list[list[str]]:
    """Sorted words by shard of their hash."""
    out: list[list[str]] = [[] for _ in range(shards)]
    for word in words:
        out[crc32(word.encode()) % shards].append(word)
    return out


def _runs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all items of runs one after another, and the ends of the runs among them."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes), ends


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(digest, doc ids, texts) of consecutive documents of about BLOCK_BYTES."""
    ids: list = []
    texts: list[str] = []
    size = 0

    def done():
        digest = hashlib.blake2b(digest_size=16)
        for i, t in zip(ids, texts, strict=True):
            raw = t.encode()
            digest.update(b"%d:%d:" % (-1 if i is None else i, len(raw)))
            digest.update(raw)
        return digest.hexdigest(), ids, texts

    for batch in (x.slice(a, 512) for x in batches for a in range(0, x.num_rows, 512)):
        found = batch.column("text").to_pylist()
        for i, t in zip(batch.column("doc_id").to_pylist(), found, strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= BLOCK_BYTES:
                yield done()
                ids, texts, size = [], [], 0
    if ids:
        yield done()


def _requests(path: str, shards: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path)
        for block, _, texts in _blocks(batches):
            words: set[str] = set()
            for text in texts:
                words.update(split.words(text))
            sent = _shard(sorted(words), shards)
            rows = [(s, _pack(_joined(w))) for s, w in enumerate(sent) if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int64()), pa.array([block] * len(rows)),
                 pa.array([p for _, p in rows], pa.binary())], ["shard", "block", "words"])

    return run


def _answers(path: str):
    @gives_back
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # the same block twice (repeated content in two tasks) asks the same: one answer
        rows = rows.drop_duplicates("block")
        lists = [_unpack(p).decode().split("\n") for p in rows["words"]]
        distinct = sorted(set().union(*lists))
        index = {w: i for i, w in enumerate(distinct)}
        found = splitter(path).encode(distinct)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        out = []
        for words in lists:
            at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            take, _ = _runs(starts[at], sizes[at])
            out.append(_pack(np.concatenate(([len(at)], sizes[at], ids[take])).astype(
                np.uint32).tobytes()))
        return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "ids": out})

    return run


@gives_back
def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, ids, texts in _blocks(batches):
        sink = pa.BufferOutputStream()
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([_pack(sink.getvalue().to_pybytes())], pa.binary())],
            ["block", "body"])


def _assembled(path: str, shards: int):
    @gives_back
    def run(bodies: pa.Table, answers: pa.Table) -> pa.Table:
        split = splitter(path)
        codes = dict(zip(answers.column("shard").to_pylist(), answers.column("ids").to_pylist(),
                         strict=True))
        parts: list[pa.Table] = []
        sizes = None
        for body in bodies.column("body").to_pylist():
            table = pa.ipc.open_stream(_unpack(body)).read_all()
            texts, table = table.column("text"), table.select(["doc_id"])
            # words by number of first appearance; a text's words are gone before the next
            index: defaultdict[str, int] = defaultdict()
            index.default_factory = index.__len__
            rows = []
            for text in texts:
                words = split.words(text.as_py())
                rows.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            del texts
            if sizes is None:  # bodies of one digest have the same words, in the same order
                sent = _shard(sorted(index), shards)
                order = np.fromiter((index[w] for words in sent for w in words), np.int64, len(index))
                sizes, ids = _joined_ids([(codes[k], len(words))
                                          for k, words in enumerate(sent) if words])
                starts = np.cumsum(sizes) - sizes
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                sizes, starts = sizes[place], starts[place]
                del sent, order, place
            del index
            # ids by position: each word's run of ids is copied to where the word stands
            made = []
            for a in range(0, len(rows), 256):
                counts = np.fromiter(map(len, rows[a : a + 256]), np.int64, len(rows[a : a + 256]))
                words = np.concatenate(rows[a : a + 256])
                take, ends = _runs(starts[words], sizes[words])
                found = ids[take]
                edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
                made.append(pa.table({
                    "doc_id": table.column("doc_id").slice(a, len(counts)),
                    "ids": pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)),
                                                    pa.array(found)),
                    "decoded": split.decode(found, edges),
                }))
            parts += made
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
                            ("decoded", pa.string())])
        return pa.concat_tables(parts).cast(schema) if parts else schema.empty_table()

    return run


def _joined_ids(answers: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids, and the ids themselves, of the words of several answers one after another."""
    sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for data, expected in answers:
        flat = np.frombuffer(_unpack(data), np.uint32)
        n = int(flat[0])
        if n != expected:
            raise ValueError("a block's answer does not fit its words")
        sizes.append(flat[1 : n + 1].astype(np.int64))
        ids.append(flat[n + 1 :].astype(np.int32))
    return np.concatenate(sizes), np.concatenate(ids)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: doc_id, ids (array<int>), decoded (text).

    Runs one job that measures the input.  Defined results: a null or empty text has no ids and
    decodes to the empty text; repeated rows, null or repeated ids each give their row's result;
    an empty table gives an empty result; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         text_or_empty().alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    requests = source.mapInArrow(_requests(tokenizer_path, shards),
                                 "shard long, block string, words binary")
    answers = requests.groupBy("shard").applyInPandas(
        _answers(tokenizer_path), "block string, shard long, ids binary")
    bodies = source.mapInArrow(_bodies, "block string, body binary")
    return bodies.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _assembled(tokenizer_path, shards), "doc_id long, ids array<int>, decoded string")


