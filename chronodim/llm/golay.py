"""The binary Golay code (23, 12, 7) as a fuzzy hash of bit segments.

The code is perfect: every 23-bit word is within 3 bits of exactly one codeword, whose 12
information bits are the word's index.  ``keys`` gives the indices of a word and of all
words one bit away.  Two words that differ in at most 2 bits have a word in the middle
that is at most one bit from either, so they share a key.
"""

from __future__ import annotations

import numpy as np

#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GENERATOR = 0b101011100011
LENGTH, INFO = 23, 12
CHECK = LENGTH - INFO


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits by information bits; error pattern (0 to 3 bits) by syndrome."""
    check = np.array([_remainder(m << CHECK) for m in range(1 << INFO)], dtype=np.int64)
    syndrome = [_remainder(1 << i) for i in range(LENGTH)]
    error = np.zeros(1 << CHECK, dtype=np.int64)
    for i in range(LENGTH):
        error[syndrome[i]] = 1 << i
        for j in range(i):
            error[syndrome[i] ^ syndrome[j]] = 1 << i | 1 << j
            for k in range(j):
                error[syndrome[i] ^ syndrome[j] ^ syndrome[k]] = 1 << i | 1 << j | 1 << k
    return check, error


_CHECK, _ERROR = _tables()


def index(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word."""
    syndrome = (words & ((1 << CHECK) - 1)) ^ _CHECK[words >> CHECK]
    return (words ^ _ERROR[syndrome]) >> CHECK


def keys(words: np.ndarray, width: int) -> np.ndarray:
    """One row of keys for each word of ``width`` bits, padded with -1; no key repeats."""
    near = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    found = np.sort(index(words[:, None] ^ near[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    found = -np.sort(-found, axis=1)
    return found[:, :max(1, int((found >= 0).sum(axis=1).max(initial=1)))]
