"""The binary Golay code of 23 bits, as a table from words to nearby codeword indices.

The code is perfect: every word is within 3 bits of exactly one codeword. A word at distance 3
has five more codewords at distance 4. Its keys are the indices (12 bits) of all of these; two
words that differ in at most two bits always share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
BITS = 23
CHECK = 11


def _remainders() -> list[int]:
    out, r = [], 1
    for _ in range(BITS):
        out.append(r)
        r <<= 1
        if r >> CHECK & 1:
            r ^= GENERATOR
    return out


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and up to six error patterns per syndrome.

    Patterns lead to the nearby codewords; unused places hold -1.
    """
    bit = _remainders()

    def syndromes(low: int, count: int) -> np.ndarray:
        out = np.zeros(1 << count, np.int64)
        for i in range(count):
            out[1 << i : 2 << i] = out[: 1 << i] ^ bit[low + i]
        return out

    patterns = np.full((1 << CHECK, 6), -1, np.int64)
    used = np.zeros(1 << CHECK, np.int64)
    leader = np.full(1 << CHECK, 9, np.int64)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            syndrome, word = 0, 0
            for p in places:
                syndrome ^= bit[p]
                word |= 1 << p
            if weight == 4 and leader[syndrome] < 3:
                continue
            leader[syndrome] = min(leader[syndrome], weight)
            patterns[syndrome, used[syndrome]] = word
            used[syndrome] += 1
    return syndromes(0, 12), syndromes(12, 11), patterns


def keys(words: np.ndarray, made: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Indices of the codewords near each word: shape (words, 6), unused places -1."""
    low, high, patterns = made
    near = patterns[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(near < 0, -1, (words[:, None] ^ near) >> CHECK)
