"""A minimal perfect hash over keys of 128 bits, in numpy."""

import numpy as np

from marketpulse.llm.suffix_dedup import mixed

ROOM = 2  # places a level has for each key that is left


class PerfectHash:
    """Gives n distinct keys the slots 0 to n-1. A key takes its place on the first level where
    no other key wants it; the rest go to the next, smaller level. Each slot keeps its key,
    so a key that is not in the table is told from one that is."""

    def __init__(self, first, second):
        self.levels, self.size = [], 0
        left = np.arange(len(first))
        while len(left):
            places = max(64, ROOM * len(left))
            place = self._place(first[left], second[left], len(self.levels), places)
            alone = np.bincount(place, minlength=places) == 1
            self.levels.append((places, alone, self.size + np.cumsum(alone) - 1))
            self.size += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 200:
                raise ValueError("the keys are not distinct")
        self.first, self.second = np.empty(self.size, np.uint64), np.empty(self.size, np.uint64)
        slots = self._slots(first, second)
        self.first[slots], self.second[slots] = first, second
        if not (np.array_equal(self.first[slots], first) and np.array_equal(self.second[slots], second)):
            raise ValueError("two keys share a slot")

    @staticmethod
    def _place(first, second, level, places):
        return (mixed(first ^ np.uint64(level * 0x5851F42D4C957F2D & (1 << 64) - 1), second) % np.uint64(places)).astype(np.int64)

    def _slots(self, first, second):
        slots = np.full(len(first), -1, dtype=np.int64)
        left = np.arange(len(first))
        for level, (places, alone, rank) in enumerate(self.levels):
            place = self._place(first[left], second[left], level, places)
            here = alone[place]
            slots[left[here]] = rank[place[here]]
            left = left[~here]
        return slots

    def slots(self, first, second):
        """The slot of each key, -1 for keys that the table does not hold."""
        slots = self._slots(first, second)
        if self.size:
            slots[(self.first[slots] != first) | (self.second[slots] != second)] = -1
        return slots
