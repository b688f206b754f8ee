"""Vectorised text: the bytes of a batch as one array, and range hashes over it."""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomial hash (arbitrary fixed values).
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
WORD = 1 << 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """Hashes of byte ranges from prefix sums: equal ranges have equal hashes.

    Sum of byte * BASE^i modulo 2^64, moved to a common origin by the inverse
    power; BASE is odd, so the inverse exists. Powers are kept between batches.
    """

    def __init__(self):
        self._inverse = pow(BASE, -1, WORD)
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            for name, base in (("_up", BASE), ("_down", self._inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self._up[:n], self._down[:n]

    def prefix(self, data: np.ndarray) -> np.ndarray:
        up, _ = self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self._powers(len(prefix))
        return mixed((prefix[ends] - prefix[starts]) * down[starts])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a newline after each, and the start of each."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.cumsum(sizes) - sizes


def word_ranges(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes that the table ``is_word`` marks."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]
