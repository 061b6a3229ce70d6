"""Ids of texts by way of their distinct words: each word is encoded once, then gathered."""

from __future__ import annotations

import numpy as np


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Flat positions of the slices [start, start + length)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class WordPool(dict):
    """word -> place in a pool of id sequences; ``encode`` gives (flat ids, lengths) of words.

    Starts anew once it holds ``limit`` words, so its memory is bounded.
    """

    def __init__(self, encode, limit: int = 150_000):
        self.encode, self.limit = encode, limit
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place

    def texts(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts (lists of words) and the offset of each text (one more)."""
        if len(self) > self.limit:
            self.empty()
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        places = np.fromiter((self[w] for words in texts for w in words), np.int64, int(counts.sum()))
        if self.fresh:
            flat, lengths = self.encode(self.fresh)
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            self.ids = np.concatenate([self.ids, flat.astype(np.int32)])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.fresh = []
        lengths = self.lengths[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[ragged(self.starts[places], lengths)], offsets
