"""Subset sums nearest to many totals, from the sorted sums of two halves."""

from __future__ import annotations

import numpy as np

# sums that one step of vectorised work compares
STEP = 4_000_000


class HalfSums:
    """Sums of the states of each half, every sum once with its best state: fewest bits, then the lowest."""

    def __init__(self, rated: list[int]):
        self.low = len(rated) // 2
        self.first, self.first_state = _sums(rated[: self.low])
        self.second, self.second_state = _sums(rated[self.low :])

    def nearest(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state of both halves nearest to each total and its distance.

        For each sum of the one half, the sums of the other on both sides of what is left are found by halving; ties go to
        the state with fewer bits, then to the lower one.
        """
        state = np.zeros(len(totals), np.int64)
        error = np.zeros(len(totals), np.int64)
        step = max(STEP // len(self.first), 1)
        for at in range(0, len(totals), step):
            rest = totals[at : at + step, None] - self.first[None, :]
            above = np.searchsorted(self.second, rest)
            found = []
            for place in (np.maximum(above - 1, 0), np.minimum(above, len(self.second) - 1)):
                both = self.first_state[None, :] | self.second_state[place] << self.low
                found.append((np.abs(rest - self.second[place]), np.bitwise_count(both).astype(np.int64), both))
            distance, bits, both = (np.concatenate(pair, axis=1) for pair in zip(*found, strict=True))
            for row in range(len(rest)):
                least = distance[row].min()
                near = np.flatnonzero(distance[row] == least)
                best = near[np.lexsort((both[row, near], bits[row, near]))[0]]
                state[at + row], error[at + row] = both[row, best], least
        return state, error


def _sums(rated: list[int]) -> tuple[np.ndarray, np.ndarray]:
    states = np.arange(1 << len(rated), dtype=np.int64)
    sums = np.zeros(len(states), np.int64)
    for i, r in enumerate(rated):
        sums += (states >> i & 1) * r
    order = np.lexsort((states, np.bitwise_count(states), sums))
    sums, states = sums[order], states[order]
    first = np.append(True, sums[1:] != sums[:-1])
    return sums[first], states[first]
