"""Golomb-Rice coding of sorted integers, vectorised: unary quotients and fixed-width remainders.

A sorted list of n values spread over [0, universe) has gaps of about universe / n; the remainder
width is chosen from that mean, which costs about two bits a value above the width.

Remainders are taken apart into bits a slice of values at a time: a bit is eight bytes while it is
shifted, so a whole list of a million values would take some 700 MB.
"""

from __future__ import annotations

import numpy as np

#: Values of a slice; a multiple of 8, so that slices end at whole bytes whatever the width.
_SLICE = 1 << 14


def encode(values: np.ndarray, universe_bits: int) -> bytes:
    """Sorted uint64 values below 2**universe_bits, repeats allowed, as one byte string."""
    n = len(values)
    width = max(0, universe_bits - max(0, n.bit_length() - 1)) if n else 0
    head = np.array([n, width], np.uint32).tobytes()
    if not n:
        return head
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    size = np.array([len(unary)], np.uint64).tobytes()
    parts = [head, size, np.packbits(unary).tobytes()]
    del quotients, ends, unary
    shifts = np.arange(width, dtype=np.uint64)
    for a in range(0, n, _SLICE):
        bits = ((gaps[a : a + _SLICE, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        parts.append(np.packbits(bits.ravel()).tobytes())
    return b"".join(parts)


def decode(data: bytes) -> np.ndarray:
    n, width = (int(x) for x in np.frombuffer(data, np.uint32, 2))
    if not n:
        return np.empty(0, np.uint64)
    size = int(np.frombuffer(data, np.uint64, 1, 8)[0])
    unary_bytes = (size + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, unary_bytes, 16), count=size)
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    del unary
    gaps = quotients.astype(np.uint64) << np.uint64(width)
    if width:
        rest = np.frombuffer(data, np.uint8, offset=16 + unary_bytes)
        places = np.uint64(1) << np.arange(width, dtype=np.uint64)
        for a in range(0, n, _SLICE):
            m = min(_SLICE, n - a)
            bits = np.unpackbits(rest[a * width // 8 :], count=m * width).reshape(m, width)
            gaps[a : a + m] += bits.astype(np.uint64) @ places
    return np.cumsum(gaps, dtype=np.uint64)
