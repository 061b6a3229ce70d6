"""Hashed character n-gram counts of texts, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .wordhash import mix

TEXTS_AT_ONCE = 64


def ngram_counts(texts: list[str], orders: tuple[int, ...], dims: int) -> np.ndarray:
    """Counts (texts x dims) of the hashed n-grams of each order; none crosses a text's end."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)) * dims, sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters to the text's end
    total = np.zeros(len(texts) * dims, np.int64)
    gram = np.zeros(len(codes), np.uint64)
    for n in range(1, max(orders) + 1):
        if n > len(codes):
            break
        gram = gram[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:]
        if n in orders:
            inside = left[:len(gram)] >= n
            cell = (mix(gram + np.uint64(n << 56)) % np.uint64(dims)).astype(np.int64) + owner[:len(gram)]
            total += np.bincount(cell[inside], minlength=len(total))
    return total.reshape(len(texts), dims).astype(np.float32)


def share(share_of: Column, *key: str) -> Column:
    """True for about the given share of rows, chosen by a hash of the key columns."""
    return F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30)) < F.ceil(share_of * (1 << 30))


def groups_of(n: int, size: int = TEXTS_AT_ONCE):
    return ((a, min(a + size, n)) for a in range(0, n, size))
