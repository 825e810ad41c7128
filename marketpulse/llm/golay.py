"""The binary Golay code of length 23: its words, and the codewords near any 23-bit value.

Every value is within three bits of exactly one codeword. A value three bits away from it
has five more codewords at four bits; any other value has none that near. Two values at
most two bits apart have a value halfway, within one bit of both, whose nearest codeword is
within four bits of both: their lists of codewords at distance four or less share an entry.
"""

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
NEAR = 6  # codewords listed per value at most


def remainder(values):
    """Of 23-bit values as polynomials, modulo the generator: the syndrome, 11 bits."""
    values = np.array(values, dtype=np.int64)
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        values ^= ((values >> bit) & 1) * (GENERATOR << (bit - (LENGTH - DATA)))
    return values


def masks(weight):
    return np.array([sum(1 << p for p in places) for places in combinations(range(LENGTH), weight)])


@lru_cache(maxsize=1)
def patterns_by_syndrome():
    """For each syndrome the error patterns of at most four bits that have it: one of up to
    three bits, and five of four bits where that one has three. -1 fills the rest."""
    table = np.full((1 << (LENGTH - DATA), NEAR), -1, dtype=np.int64)
    used = np.zeros(len(table), dtype=np.int64)
    for weight in range(5):
        patterns = masks(weight)
        for pattern, syndrome in zip(patterns.tolist(), remainder(patterns).tolist()):
            if weight < 4 or bin(int(table[syndrome, 0])).count("1") == 3:
                table[syndrome, used[syndrome]] = pattern
                used[syndrome] += 1
    return table


def near_indices(values):
    """The 12-bit indices of the codewords within four bits: an array of six per value, -1
    where there are fewer."""
    values = np.asarray(values, dtype=np.int64)
    patterns = patterns_by_syndrome()[remainder(values)]
    indices = (values[:, None] ^ patterns) >> (LENGTH - DATA)
    return np.where(patterns >= 0, indices, -1)
