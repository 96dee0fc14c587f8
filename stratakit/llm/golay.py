"""The perfect binary Golay code of length 23, as a fuzzy hash.

Every 23-bit word lies within three bits of exactly one codeword. The keys of a word are the codewords reached from the
word itself and from each of its 23 neighbours: one to six indices of 12 bits. Two words at most two bits apart always
share a key, because some word lies within one bit of both; words further apart share one with falling probability.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, DATA_BITS, MAX_KEYS = 23, 12, 6
#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - DATA_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - DATA_BITS))
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error pattern of each syndrome."""
    low = np.array([_remainder(w) for w in range(1 << 12)], dtype=np.uint32)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], dtype=np.uint32)
    error = np.zeros(1 << 11, dtype=np.uint32)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            e = sum(1 << b for b in bits)
            error[_remainder(e)] = e
    return low, high, error


def decode(words: np.ndarray) -> np.ndarray:
    """Index (its 12 data bits) of the codeword nearest to each word."""
    low, high, error = _tables()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ error[syndrome]) >> (LENGTH - DATA_BITS)


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices reachable from each word, sorted along a new last axis of 24, and which of them are first occurrences."""
    words = np.asarray(words, dtype=np.uint32)
    flips = np.array([0, *[1 << b for b in range(LENGTH)]], dtype=np.uint32)
    found = np.sort(decode(words[..., None] ^ flips), axis=-1)
    fresh = np.ones(found.shape, dtype=bool)
    fresh[..., 1:] = found[..., 1:] != found[..., :-1]
    return found, fresh
