"""The perfect binary Golay code (23,12,7), vectorised.

Every 23-bit word lies within distance 3 of exactly one codeword. A word and its 23 neighbours at
distance 1 decode to one codeword (word at distance 0 to 2 from it) or to six (distance 3), so any two
words at distance 2 or less share one of their codewords, and words somewhat further apart often do.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

N, K = 23, 12
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for bit in range(N - 1, N - K - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (N - K))
    return word


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each byte at each of three places; error pattern of each syndrome; syndrome of each single bit."""
    parity = np.array([_remainder(1 << b) for b in range(N)], np.int32)
    syndromes = np.zeros((3, 256), np.int32)
    for place in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and place * 8 + bit < N:
                    syndromes[place, value] ^= parity[place * 8 + bit]
    errors = np.zeros(1 << (N - K), np.int32)
    for weight in (3, 2, 1):
        for bits in itertools.combinations(range(N), weight):
            errors[functools.reduce(lambda a, b: a ^ int(parity[b]), bits, 0)] = sum(1 << b for b in bits)
    errors[0] = 0
    return syndromes, errors, parity


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six codeword indices a word (int16, as N x 6) and how many of them count (1 or 6).

    The first is the word's own codeword. Words at distance 3 of it have five more at distance 4.
    """
    syndromes, errors, parity = tables()
    words = words.astype(np.int32)
    syn = syndromes[0][words & 255] ^ syndromes[1][words >> 8 & 255] ^ syndromes[2][words >> 16 & 127]
    own = (words ^ errors[syn]) >> (N - K)
    out = np.repeat(own[:, None], 6, axis=1)
    far = np.flatnonzero(np.bitwise_count(errors[syn]) == 3)
    flips = np.int32(1) << np.arange(N, dtype=np.int32)
    near = (words[far, None] ^ flips ^ errors[syn[far, None] ^ parity]) >> (N - K)
    near.sort(axis=1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    fresh &= near != own[far, None]
    out[far, 1:] = near[fresh].reshape(-1, 5)
    counts = np.ones(len(words), np.int8)
    counts[far] = 6
    return out, counts
