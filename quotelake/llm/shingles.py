"""Word shingles of whole texts as 64-bit hashes, with numpy inside tasks."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20240131).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle sets of texts; A-Z count as a-z, words are parted by white space."""

    def __init__(self, width: int):
        self.width = width
        self.up = self.down = powers(_BASE, 0)

    def words(self, text: str) -> np.ndarray:
        """A hash of each word, from differences of one running sum over the bytes."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
        if len(raw) >= len(self.up):
            size = max(1 << 16, 2 * len(raw))
            self.up, self.down = powers(_BASE, size), powers(_BACK, size)
        solid = np.concatenate(([False], ~_BLANK[raw], [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        first, last = edges[0::2], edges[1::2]
        sums = np.concatenate(
            (np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * self.up[: len(raw)], dtype=np.uint64))
        )
        value = (sums[last] - sums[first]) * self.down[first]
        return mix(value + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles; a shorter text is one shingle, no words are none."""
        if not text:
            return np.zeros(0, np.int64)
        found = self.words(text)
        if not len(found):
            return np.zeros(0, np.int64)
        width = min(self.width, len(found))
        total = np.full(len(found) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total = mix(total * np.uint64(0xA24BAED4963EE407) + found[k : k + len(total)])
        return np.unique(total.view(np.int64))
