"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at a time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 2 << 20  # bytes of text handled at a time, or one text
BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
STEP = np.uint64(0xD6E8FEB86659FD93)
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]  # of bytes, A-Z as a-z


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """BASE^i and its inverse modulo 2^64, for i below n at least; kept for the next piece."""
    if not POWERS or len(POWERS[0]) < n:
        n = max(PIECE, 1 << math.ceil(math.log2(n + 1)))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b)])) for b in (BASE, inverse)]
    return POWERS


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every run of non-blank bytes."""
    solid = ~BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(VALUES[data] * up[:len(data)])])
    return start, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * STEP)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words, one for the whole sequence; none without words."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    start, word = word_hashes(data)
    first = np.searchsorted(start, offsets)
    rolled = np.full(max(0, len(word) - width + 1), np.uint64(width))
    for i in range(width):
        rolled = mix(rolled * STEP + word[i:len(rolled) + i])
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        else:
            h = np.full(min(1, b - a), np.uint64(b - a))
            for w in word[a:b]:
                h = mix(h * STEP + w)
            out.append(h)
    return out


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def pieces(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(start, texts as bytes; NULL is empty) of ``PIECE`` bytes, or one text."""
    start, texts, n = 0, [], 0
    for i, value in enumerate(column.cast(pa.binary())):
        texts.append(value.as_py() or b"")
        n += len(texts[-1])
        if n >= PIECE:
            yield start, texts
            start, texts, n = i + 1, [], 0
    if texts:
        yield start, texts
