"""Words, and 64-bit hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: A word is a maximal run of letters and digits.
WORD = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-cased words of a text, in order."""
    return [w.lower() for w in WORD.findall(text)] if text else []


class WordHash(dict):
    """Word -> 64-bit hash; each worker hashes a word once. It forgets all when it grows too large."""

    MOST = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * _ODD + h[j : j + n]
    return mix(out)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, h.dtype)
    step, out = 1, h
    while 2 * step <= width:
        out = np.minimum(out[: len(out) - step], out[step:])
        step *= 2
    return np.minimum(out[:n], out[width - step : width - step + n])
