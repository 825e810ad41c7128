"""A wavelet matrix over a sequence of small numbers, in numpy."""

import numpy as np

BLOCK = 64  # bytes whose set bits are counted in advance


class Bits:
    """A bit sequence that counts its set bits in front of any place: packed bits, and the
    count before each block of them."""

    def __init__(self, bits):
        self.size = len(bits)
        packed = np.packbits(bits)
        self.packed = np.append(packed, np.zeros(-len(packed) % BLOCK + BLOCK, dtype=np.uint8))
        per_block = np.bitwise_count(self.packed.reshape(-1, BLOCK)).sum(axis=1, dtype=np.int64)
        self.before = np.append(0, np.cumsum(per_block))

    def rank(self, place):
        """How many of the first `place` bits are set."""
        whole, rest = divmod(place, 8)
        block = whole // BLOCK
        count = int(self.before[block]) + int(np.bitwise_count(self.packed[block * BLOCK:whole]).sum(dtype=np.int64))
        return count + (int(self.packed[whole]) >> (8 - rest)).bit_count() if rest else count


class WaveletMatrix:
    """Counts each symbol of 0 to 2**bits - 1 in any prefix of the sequence. One plane per
    bit, the highest first; below each the symbols are split stably, zeros to the front."""

    def __init__(self, symbols, bits):
        self.size, self.bits = len(symbols), bits
        self.planes = []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit & 1).astype(bool)
            plane = Bits(ones)
            self.planes.append((bit, plane, self.size - plane.rank(self.size)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol, place):
        """How often `symbol` stands in the first `place` places."""
        low, high = 0, place
        for bit, plane, zeros in self.planes:
            low_ones, high_ones = plane.rank(low), plane.rank(high)
            if symbol >> bit & 1:
                low, high = zeros + low_ones, zeros + high_ones
            else:
                low, high = low - low_ones, high - high_ones
        return high - low

    def place_of(self, symbols, nth):
        """The shortest prefix with `nth` places of any of the symbols, by bisection on
        their ranks. There must be so many."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            if sum(self.rank(s, middle) for s in symbols) < nth:
                low = middle + 1
            else:
                high = middle
        return low
