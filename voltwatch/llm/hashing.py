"""Vectorised hashes of words, k-grams and windows (numpy helpers used inside tasks)."""

from __future__ import annotations

import functools

import numpy as np

_RNG = np.random.default_rng(20240607)
BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=64)
def _powers(bits: int, inverse: bool) -> np.ndarray:
    out = np.full(1 << bits, BASE_INVERSE if inverse else BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    return _powers(max(12, int(n).bit_length()), inverse)[:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word ``[^\\x20\\x09-\\x0D]+`` of the bytes."""
    b = np.frombuffer(data, np.uint8)
    n = len(b)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~_SPACE[b]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[b] * powers(n), out=total[1:])
    return mix((total[end] - total[start]) * powers(n, True)[start] if n else total[:0]), start, end


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive symbols (uint64); k is a power of two."""
    h, size, base = symbols, 1, BASE
    while size < k:
        with np.errstate(over="ignore"):
            h = h[:-size] * base + h[size:]
            base = base * base
        size *= 2
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    out, size = x, 1
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = w - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(symbols: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, anchor place, first start, last start) for runs of windows.

    A window is ``length`` consecutive symbols; its anchor is its k-gram of the
    least hash, the leftmost among equals, so equal windows have their anchor
    at the same place inside them.  Consecutive windows with the same anchor
    form one run of starts.
    """
    n = len(symbols)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    grams = gram_hashes(symbols, k)
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - k + 1)
    place = (least & low).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [len(place) - 1]))
    place = place[first]
    return grams[place], place, first, last
