"""Word hashes and shingle hashes of whole texts, as numpy arrays."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

from tidemark.llm.caches import claim

#: Words whose hashes a worker remembers.
REMEMBERED = 200_000
WIDTH = 5

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words; a worker process keeps one from task to task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@functools.cache
def word_hashes() -> WordHashes:
    return WordHashes()


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and 0x09 to 0x0D, with A-Z in lower case."""
    return text.lower().split()


def hashed(text: bytes) -> np.ndarray:
    claim("shingles", word_hashes().clear)
    found = words(text)
    return np.fromiter(map(word_hashes().__getitem__, found), dtype=np.uint64, count=len(found))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, an empty one none."""
    h = hashed(text)
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    out = np.full(n, np.uint64(min(len(h), width)))
    for i in range(min(width, len(h))):
        out = out * _ODD + h[i : i + n]
        out ^= out >> np.uint64(32)
    return np.unique(mixed(out))
