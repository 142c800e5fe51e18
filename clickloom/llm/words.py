"""Words, shingles and hashes of one text, in numpy.

A word is a run of characters other than space and U+0009 to U+000D; A-Z are lower-cased,
other letters are left alone.  `bytes.lower` and `bytes.split` do exactly that.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MUL1 = np.uint64(0xBF58476D1CE4E5B9)
_MUL2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values whose output bits all depend on the input."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MUL1
    x = (x ^ (x >> np.uint64(27))) * _MUL2
    return x ^ (x >> np.uint64(31))


def words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; none for null."""
    return text.lower().split() if text else []


def word_hashes(text: bytes | None) -> np.ndarray:
    """One 64-bit hash per word, in order."""
    found = words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_sequence(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash for every run of `width` words, in order; a shorter text is one shingle, no words are none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    acc = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        acc = mix(acc + hashes[j : n - width + 1 + j])
    return acc


def shingle_set(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(shingle_sequence(word_hashes(text), width))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, the same for a seed on every machine."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed)) | np.uint64(1)


def min_hashes(shingles: np.ndarray, multipliers: np.ndarray, block: int = 4096) -> np.ndarray:
    """For each multiplier the least product over all shingles; memory stays bounded for long texts."""
    best = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), block):
        np.minimum(best, (shingles[start : start + block, None] * multipliers[None, :]).min(axis=0), out=best)
    return best
