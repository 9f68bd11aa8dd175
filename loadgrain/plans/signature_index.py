"""A search index over load signatures: classes of deviation, means sorted within each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# candidates that one step of vectorised work compares
STEP_ROWS = 2_000_000
# distances are compared after rounding to 9 places, so those that are this near to the least may tie with it
TIE = 2e-9


class SignatureIndex:
    """Signatures of one direction, dealt into classes by the power of two of their deviation."""

    def __init__(self, means: np.ndarray, deviations: np.ndarray):
        power = np.floor(np.log2(deviations)).astype(np.int64)
        order = np.lexsort((means, power))
        self.row, self.mean, self.std = order, means[order], deviations[order]
        edges = np.flatnonzero(np.append(True, np.diff(power[order]) != 0)) if len(order) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(order))
        self.classes = [(a, b, float(self.std[a:b].max())) for a, b in zip(edges.tolist(), ends.tolist(), strict=True)]

    def finalists(self, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each step the rows of all signatures that may be nearest after rounding, and how many they are.

        The neighbours of a step in each class, found by halving, give a distance that the best can't exceed. A class whose
        nearest mean is too far for it even at its widest deviation is left out; of another, only means within that reach are compared.
        """
        least = np.full(len(steps), np.inf)
        gaps = []
        for a, b, _ in self.classes:
            mean, std = self.mean[a:b], self.std[a:b]
            at = np.searchsorted(mean, steps)
            left, right = np.maximum(at - 1, 0), np.minimum(at, b - a - 1)
            to_left, to_right = np.abs(steps - mean[left]), np.abs(steps - mean[right])
            least = np.minimum(least, np.minimum(to_left / std[left], to_right / std[right]))
            gaps.append(np.minimum(to_left, to_right))
        reach = least * (1 + 1e-12) + TIE
        who, row, away = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for (a, b, widest), gap in zip(self.classes, gaps, strict=True):
            todo = np.flatnonzero(gap <= reach * widest)
            low = np.searchsorted(self.mean[a:b], steps[todo] - reach[todo] * widest, side="left")
            count = np.searchsorted(self.mean[a:b], steps[todo] + reach[todo] * widest, side="right") - low
            total, at = np.cumsum(count), 0
            while at < len(todo):
                stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + STEP_ROWS, side="right")), at + 1)
                n = count[at:stop]
                event = np.repeat(todo[at:stop], n)
                place = np.repeat(a + low[at:stop] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                distance = np.abs(steps[event] - self.mean[place]) / self.std[place]
                np.minimum.at(least, event, distance)
                near = distance <= reach[event]
                who.append(event[near])
                row.append(self.row[place[near]])
                away.append(distance[near])
                at = stop
        event, row, distance = (np.concatenate(x) for x in (who, row, away))
        best = distance <= least[event] * (1 + 1e-12) + TIE
        event, row = event[best], row[best]
        order = np.argsort(event, kind="stable")
        return row[order], np.bincount(event, minlength=len(steps))


class Signatures:
    """The signatures of all directions, as a table of ``direction``, ``label``, ``mean_step``, ``std_step``."""

    def __init__(self, table: pa.Table):
        self.known = table.select(["label", "mean_step", "std_step"]).combine_chunks()
        direction = np.array(table.column("direction").to_pylist(), object)
        self.of: dict[object, tuple[np.ndarray, SignatureIndex]] = {}
        mean, std = (table.column(c).to_numpy() for c in ("mean_step", "std_step"))
        for d in set(direction.tolist()) - {None}:
            rows = np.flatnonzero(direction == d)
            self.of[d] = rows, SignatureIndex(mean[rows], std[rows])

    def finalists(self, direction: pa.Array, step: pa.Array) -> pa.Array:
        """A list of signatures for each event: those that may be the nearest; empty without a step or known direction."""
        codes = direction.dictionary_encode()
        which = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        value = step.cast(pa.float64()).to_numpy(zero_copy_only=False)
        count = np.zeros(len(value), np.int64)
        owner, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, d in enumerate(codes.dictionary.to_pylist()):
            if d not in self.of:
                continue
            mine = np.flatnonzero((which == i) & ~np.isnan(value))
            names, index = self.of[d]
            found, n = index.finalists(value[mine])
            count[mine] = n
            owner.append(np.repeat(mine, n))
            rows.append(names[found])
        order = np.argsort(np.concatenate(owner), kind="stable")
        taken = self.known.take(pa.array(np.concatenate(rows)[order]))
        values = pa.StructArray.from_arrays([c.combine_chunks() for c in taken.columns], names=taken.column_names)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), values)
