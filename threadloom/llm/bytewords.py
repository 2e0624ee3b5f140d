"""Words of many texts at once on their UTF-8 bytes: boundaries and 64-bit hashes, by a few array passes."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64)))) for x in (_BASE, _INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def word_bytes(digits: bool = True) -> np.ndarray:
    """Which bytes belong to words, after lower-casing: a-z, all of non-ASCII characters, and digits if asked for."""
    table = np.zeros(256, bool)
    table[128:] = table[ord("a") : ord("z") + 1] = True
    table[ord("0") : ord("9") + 1] = digits
    return table


def word_bounds(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


class Hasher:
    """Hashes of slices of one byte array: hash(starts, ends) depends on the bytes of the slice only."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])))

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def blocks(texts: list[bytes], size: int = 1_000_000):
    """(first, last, lower-cased bytes, start of each text and the end) for runs of texts, a line feed after each text."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= size):
            n += len(texts[j]) + 1
            j += 1
        starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts[i:j]])))
        yield i, j, np.frombuffer((b"\n".join(texts[i:j]) + b"\n").lower(), np.uint8), starts
        i = j
