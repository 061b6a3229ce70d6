"""Vectorised word hashes of texts: polynomial prefix sums over code points, modulo 2**64.

A word is a run of non-blank characters, where the blanks are those of ``str.split``.
"""

from __future__ import annotations

import numpy as np

from .common import resident

BLANKS = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BASE = np.uint64(0x9E3779B97F4A7C15)
MASK64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i up to n at least; one table a worker, which grows."""
    store = resident("powers", dict)
    if len(store.get("up", ())) <= n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        size = 1 << max(16, int(n).bit_length())
        for name, b in (("up", BASE), ("down", inverse)):
            store[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]))
    return store["up"], store["down"]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each range, equal for equal content anywhere."""
    up, down = powers(len(values))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a list of texts, flat: ``hashes``; text i has words [offsets[i], offsets[i+1])."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        table = np.zeros(0x3001, bool)
        table[BLANKS] = True
        blank = table[np.minimum(codes, 0x3000)] & (codes <= 0x3000)
        edges = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        self.hashes = range_hashes(codes.astype(np.uint64) + np.uint64(1), starts, ends)
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.offsets = np.searchsorted(starts, firsts)
        #: code-point places of each word in its own text
        own = np.repeat(firsts[:-1], np.diff(self.offsets))
        self.starts, self.ends = starts - own, ends - own

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words (all words where a text has fewer) and their offsets."""
        counts = self.counts()
        n = np.where(counts > 0, np.maximum(counts - (k - 1), 1), 0)
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.offsets[:-1] - (ends - n), n)
        last = np.repeat(self.offsets[1:], n)
        return range_hashes(self.hashes, at, np.minimum(at + k, last)), np.concatenate([[0], ends])
