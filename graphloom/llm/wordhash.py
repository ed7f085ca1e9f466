"""Word hashes and hashes of word runs for whole batches of texts, shared by the operators on word windows."""

from __future__ import annotations

import numpy as np
import xxhash

#: words whose hashes a worker keeps; beyond that it starts anew
CACHE = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_KNOWN = _Hashes()


def hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    if len(_KNOWN) > CACHE:
        _KNOWN.clear()
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads them evenly."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words; those that cross from one text to the next mean nothing."""
    count = max(0, len(values) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += values[k:k + count]
        out ^= out >> np.uint64(29)
    return mixed(out)
