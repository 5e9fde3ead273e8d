"""Hashed word shingles of texts (inside tasks)."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SHINGLE = 5
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """Word to 64-bit hash; forgets when it holds ``most`` words."""

    most = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of an ASCII-lower-cased text.

    Fewer words: the whole sequence as one shingle.  No words: empty.
    """
    found = _WORD.findall((text or b"").lower())
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = len(ids) - size + 1
    with np.errstate(over="ignore"):
        h = ids[:n].copy()
        for k in range(1, size):
            h ^= h >> _SHIFT
            h *= _MUL
            h += ids[k : k + n]
        h ^= h >> _SHIFT
        h *= _MUL
        h ^= h >> np.uint64(32)
    return np.unique(h)
