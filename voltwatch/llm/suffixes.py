"""Suffix sorting of small collections of blocks (numpy helper used inside tasks)."""

from __future__ import annotations

import numpy as np


class SuffixRanks:
    """Suffix order of blocks of integers.

    Every block ends with a terminator of its own, so no match crosses a
    block.  ``levels[j][i]`` ranks the 2^j symbols from place i on; the last
    level ranks whole suffixes.
    """

    def __init__(self, blocks: list[np.ndarray]):
        m = len(blocks)
        sizes = np.array([len(b) for b in blocks], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        self.ends = self.starts + sizes
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        for s, e, b in zip(self.starts, self.ends, blocks, strict=True):
            text[s:e] = b
        _, dense = np.unique(text, return_inverse=True)
        text = dense.reshape(-1) + m
        text[self.ends] = np.arange(m)
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].reshape(-1)
        self.levels, width = [rank], 1
        while width < n and rank.max(initial=0) < n - 1:
            key = rank * np.int64(n + 1)
            key[:-width] += rank[width:] + 1
            rank = np.unique(key, return_inverse=True)[1].reshape(-1)
            self.levels.append(rank)
            width *= 2
        self.text = self.levels[0]
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes from a[i] and b[i] (different places)."""
        n = len(self.text)
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[j], 1 << j
            ok = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[ok] = level[a[ok]] == level[b[ok]]
            out[same] += width
            a[same] += width
            b[same] += width
        return out
