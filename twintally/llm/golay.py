"""The binary [23, 12, 7] Golay code as a fuzzy hash of short bit strings.

Every 23-bit word lies within 3 bits of exactly one codeword. The codewords within 4
bits of a word number one (if the nearest is at most 2 bits away) or six. Two words
that differ in at most 2 bits always have one of these codewords in common, so the
codewords' indices are keys under which near words meet.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS, REACH = 23, 11, 4

# Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011

MOST_KEYS = 6


def _remainder(word: int) -> int:
    for shift in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits; error patterns and their number by syndrome."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.uint32)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.uint32)
    patterns = np.zeros((1 << CHECK_BITS, MOST_KEYS), np.uint32)
    number = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(REACH + 1):
        for places in combinations(range(LENGTH), weight):
            word = sum(1 << p for p in places)
            syndrome = low[word & 0xFFF] ^ high[word >> 12]
            patterns[syndrome, number[syndrome]] = word
            number[syndrome] += 1
    return low, high, patterns, number


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of up to 23 bits: an (n, 6) array of codeword indices, and how many of each row count.

    An index is the codeword's upper 12 bits, which determine it.
    """
    low, high, patterns, number = _tables()
    words = words.astype(np.uint32)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ patterns[syndrome]) >> CHECK_BITS, number[syndrome]
