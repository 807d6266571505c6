"""Minimal perfect hashing of 64-bit codes, in numpy.

Codes go through levels of bit tables. In each level a code takes its cell if
it has it alone; the others go on to the next, smaller level. A code's slot is
the number of taken cells before its own, so ``n`` distinct codes get the slots
0 to n - 1 and the table needs a few bits a code. A code that was not built in
finds no cell or someone else's slot; the caller verifies slots by what it
stored there.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix

ROOM = 2  # cells of a level for each code that reaches it
_U = np.uint64
_LEVEL = 0x9E3779B97F4A7C15


class PerfectHash:
    def __init__(self, codes: np.ndarray):
        """``codes``: distinct uint64 values."""
        self.size = len(codes)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (taken, taken cells before)
        left, before = codes, 0
        while len(left):
            cells = self._cells(left, len(self.levels), ROOM * len(left))
            taken = np.bincount(cells, minlength=ROOM * len(left)) == 1
            ranks = before + np.cumsum(taken) - taken
            self.levels.append((taken, ranks))
            before += int(taken.sum())
            left = left[~taken[cells]]

    @staticmethod
    def _cells(codes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(codes + _U((level + 1) * _LEVEL % (1 << 64))) % _U(size)).astype(np.int64)

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """The slot of every code; -1 for some of those not built in."""
        out = np.full(len(codes), -1, np.int64)
        open_ = np.arange(len(codes))
        for level, (taken, ranks) in enumerate(self.levels):
            if not len(open_):
                break
            cells = self._cells(codes[open_], level, len(taken))
            here = taken[cells]
            out[open_[here]] = ranks[cells[here]]
            open_ = open_[~here]
        return out
