"""Byte-level BPE ids of many texts at once: each distinct stretch of text is encoded once a task.

The tokenizer's words never reach over a single space that stands between two characters other
than white space; such a space begins a word.  Texts are cut there, and nowhere else.  Stretches
are grouped by a hash and compared byte by byte, so the grouping is exact; new ones are encoded
together, and ids return by position.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from tallygate.llm.common import kept, span_hashes

#: Bytes whose stretches are hashed at once; bytes remembered before they are forgotten; longest
#: stretch that is grouped and remembered.
WINDOW = (1 << 21) - 64
REMEMBERED = 1 << 24
LONGEST = 64

# Fixed value: the word pattern of byte-level BPE files.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# first bytes of all characters beyond ASCII that are white space (and of many that are not)
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def cuts(buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts of the stretches of ``buffer``, whose texts begin at ``starts`` (none is empty)."""
    n = len(buffer)
    p = np.flatnonzero(buffer == 32)
    p = p[(p > 0) & (p < n - 1)]
    before, after = buffer[p - 1], buffer[p + 1]
    inside = np.ones(n + 1, bool)
    inside[starts] = False
    ok = ~_BLANK[before] & ~_BLANK[after] & ~_LEADS[after] & inside[p] & inside[p + 1]
    ok &= (before < 128) | ~(_LEADS[buffer[p - 2]] | _LEADS[buffer[np.maximum(p - 3, 0)]])
    first = np.zeros(n, bool)
    first[starts] = True
    first[p[ok]] = True
    return np.flatnonzero(first)


def _positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class _Store:
    """Spans of values one after another, in arrays that grow."""

    def __init__(self, kind: type) -> None:
        self.items = self.used = 0
        self.starts, self.sizes = np.zeros(4096, np.int64), np.zeros(4096, np.int64)
        self.flat = np.zeros(16384, kind)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.items + len(sizes) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        to = slice(self.items, self.items + len(sizes))
        self.sizes[to] = sizes
        self.starts[to] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + len(values)] = values
        self.items += len(sizes)
        self.used += len(values)

    def positions(self, entry: np.ndarray) -> np.ndarray:
        return _positions(self.starts[entry], self.sizes[entry])


class Encoder:
    """The ids that the tokenizer file gives to whole texts."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        alphabet = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                  for m in spec["model"]["merges"]]
        pre = spec["pre_tokenizer"]
        # merging by rank is merging by id only where ids follow the merges
        in_order = all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges))
        if (pre["type"], pre["add_prefix_space"], pre["use_regex"]) != ("ByteLevel", False, True) or (
                spec["normalizer"] or not in_order or any(len(s) < 2 for s in special)):
            raise ValueError(f"not a byte-level BPE file of the expected form: {path}")
        ranks = {bytes(alphabet[c] for c in token): i
                 for token, i in vocab.items() if token not in special}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.id_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.id_bytes[i] = len(piece)
        # the first two bytes are enough to be careful
        self.special = sorted({tuple(s.encode()[:2]) for s in special})
        self._forget()

    # ------------------------------------------------------------------ what is remembered

    def _forget(self) -> None:
        """Known stretches, sorted by hash: their place in the stored bytes and ids."""
        self.hashes = np.empty(0, np.uint64)
        self.entry = np.empty(0, np.int64)
        self.text, self.ids = _Store(np.uint8), _Store(np.uint32)

    def _remember(self, hashes: np.ndarray, text: np.ndarray, sizes: np.ndarray,
                  ids: np.ndarray, counts: np.ndarray) -> None:
        """Adds stretches (sorted by hash, and new): their bytes and ids, one after another."""
        at = np.searchsorted(self.hashes, hashes)
        self.entry = np.insert(self.entry, at, self.text.items + np.arange(len(hashes)))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.text.add(text, sizes)
        self.ids.add(ids, counts)

    # ------------------------------------------------------------------ encoding

    def _library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(
            [w.decode() for w in words], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return counts, np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum()))

    def _plain(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether stretches may stand between others: one space, then no white space at the
        ends, only characters every library classes alike, and no special token."""
        # lead bytes up to 0xD3 are characters below U+0500; 0xC2 leads the white space there
        doubtful = (buffer > 0xD3) | (buffer == 0xC2)
        for a, b in self.special:
            doubtful[:-1] |= (buffer[:-1] == a) & (buffer[1:] == b)
        before = np.concatenate(([0], np.cumsum(doubtful)))
        second = buffer[np.minimum(starts + 1, len(buffer) - 1)]
        return ((buffer[starts] == 32) & (ends - starts > 1) & ~_BLANK[second]
                & ~_BLANK[buffer[ends - 1]] & (before[ends] == before[starts]))

    def _new(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of some different stretches, and the ids.

        Plain ones are encoded as one text and told apart by the bytes their ids stand for.
        """
        plain = self._plain(buffer, starts, ends)
        a, n = starts[plain], (ends - starts)[plain]
        ids = self.fast.encode_to_numpy(buffer[_positions(a, n)].tobytes().decode())
        last = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(n))
        counts = np.zeros(len(starts), np.int64)
        counts[plain] = np.diff(last, prepend=-1)
        other = np.flatnonzero(~plain)
        if not len(other):
            return counts, ids
        words = [buffer[x:y].tobytes() for x, y in zip(starts[other], ends[other], strict=True)]
        counts[other], more = self._library(words)
        # both kinds back in the order of the stretches
        both = np.concatenate((ids, more))
        begin = np.zeros(len(starts), np.int64)
        begin[plain] = np.cumsum(counts[plain]) - counts[plain]
        begin[other] = len(ids) + np.cumsum(counts[other]) - counts[other]
        return counts, both[_positions(begin, counts)]

    def _window(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each stretch, and the ids."""
        if self.text.used > REMEMBERED:
            self._forget()
        lengths = ends - starts
        hashes, first, group = np.unique(span_hashes(buffer, starts, ends), return_index=True,
                                         return_inverse=True)
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        new = first[~known]
        counts, ids = self._new(buffer, starts[new], ends[new])
        self._remember(hashes[~known], buffer[_positions(starts[new], lengths[new])],
                       lengths[new], ids, counts)
        entry = self.entry[np.searchsorted(self.hashes, hashes)][group]
        if not ((self.text.sizes[entry] == lengths).all() and np.array_equal(
                self.text.flat[self.text.positions(entry)], buffer[_positions(starts, lengths)])):
            # two stretches share a hash: each is encoded by itself
            return self._library([buffer[x:y].tobytes()
                                  for x, y in zip(starts, ends, strict=True)])
        return self.ids.sizes[entry], self.ids.flat[self.ids.positions(entry)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text of a string array without nulls."""
        raw = texts.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset :][: len(raw) + 1]
        if not len(raw) or offsets[0] == offsets[-1]:
            return [np.empty(0, np.uint32) for _ in range(len(raw))]
        buffer = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = cuts(buffer, offsets[:-1][np.diff(offsets) > 0])
        ends = np.append(starts[1:], len(buffer))
        counts = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        long = np.flatnonzero(ends - starts > LONGEST)
        a = 0
        for stop in [*long.tolist(), len(starts)]:
            while a < stop:  # stretches of about WINDOW bytes
                b = min(stop, max(a + 1, int(np.searchsorted(starts, starts[a] + WINDOW))))
                lo, hi = starts[a], ends[b - 1]
                counts[a:b], ids = self._window(buffer[lo:hi], starts[a:b] - lo, ends[a:b] - lo)
                parts.append(ids)
                a = b
            if stop < len(starts):
                counts[stop : stop + 1], ids = self._library(
                    [buffer[starts[stop] : ends[stop]].tobytes()])
                parts.append(ids)
                a = stop + 1
        ids = np.concatenate(parts)
        edges = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, offsets)]
        return [ids[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


@kept
def encoder(path: str) -> Encoder:
    return Encoder(path)
