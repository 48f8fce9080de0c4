"""Vectorised scanning of UTF-8 texts into hashed words and shingles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Space, tab, line feed, vertical tab, form feed and carriage return separate words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _RADIX, dtype=np.uint64)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_RADIX), -1, 1 << 64)), dtype=np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, by sums of powers; spans are in order and don't overlap."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        a = start[i]
        j = max(i + 1, int(np.searchsorted(end, a + _PIECE, "right")))
        b = end[j - 1]
        up, down = _powers(1 << max(20, int(b - a).bit_length()))
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(_VALUE[buf[a:b]] * up[: b - a], out=sums[1:])
        s = start[i:j] - a
        out[i:j] = mix((sums[end[i:j] - a] - sums[s]) * down[s])
        i = j
    return out


class Words:
    """Words of a run of texts: hash of each, and of its first `prefix` bytes if asked; doc is the index of its text."""

    def __init__(self, texts: list[bytes], lower: bool = True, prefix: int = 0):
        joined = b" ".join(texts)
        buf = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
        self.buf = buf
        first = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=first[1:])
        space = _SPACE[buf] if len(buf) else np.zeros(0, dtype=bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.count = np.diff(np.searchsorted(self.start, first))
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.hash = span_hashes(buf, self.start, self.end)
        self.head = span_hashes(buf, self.start, np.minimum(self.end, self.start + prefix)) + np.uint64(prefix) if prefix else None


def shingles(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; of the whole run where it is shorter; none without words."""
    n = len(word_hash)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    width = min(n, width)
    out = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0x2545F4914F6CDD1D) + word_hash[k : n - width + 1 + k]
    return mix(out + np.uint64(width))
