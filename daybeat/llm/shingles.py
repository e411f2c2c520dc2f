"""Word and shingle hashes of whole texts, as numpy arrays inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers, one for each place of a word in a shingle, from one generator.
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)        # fixed value: finaliser of a public 64-bit hash
_HALF = np.uint64(33)


def word_hashes(raw: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased; words end at space and \\x09-\\x0D."""
    words = (raw or b"").lower().split()       # for bytes both work on ASCII alone
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, in order; fewer words give one hash of them all."""
    n = len(words)
    if n == 0:
        return words
    span = min(length, n)
    total = np.full(n - span + 1, span, np.uint64)
    for k in range(span):
        total += words[k:n - span + 1 + k] * _PLACES[k]
    return mixed(total)


def shingle_set(raw: bytes | None, length: int) -> np.ndarray:
    """Sorted different shingle hashes of a text."""
    return np.unique(shingle_hashes(word_hashes(raw), length))
