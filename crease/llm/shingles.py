"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SHINGLE = 5
_FIND = re.compile(r"\w+").findall
_CACHE = 100_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_HASHES = _Hashes()
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) | 1 for k in range(64)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _FIND(text.lower()) if text else []


def shingle_hashes(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``n`` words, in text order; none in shorter texts."""
    words = words_of(text)
    size = len(words) - n + 1
    if size < 1:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += hashes[k:k + size] * _ODD[k]
    return mix(total)
