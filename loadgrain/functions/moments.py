"""Number, means and co-moments of many columns, merged exactly over tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a step of work
STEP_ROWS = 10_000
# tasks that merge the results of all others, and so the most rows of one value that reach the driver
MERGING = 64


@dataclass(frozen=True)
class Moments:
    """``spread[i, j]`` is the sum over rows of the products of both columns' distances from their means."""

    n: int
    mean: np.ndarray
    spread: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        """The moments of both rows together, after Chan, Golub and LeVeque (1979)."""
        n = self.n + other.n
        apart = other.mean - self.mean
        spread = self.spread + other.spread + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), spread)


def complete_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of doubles without a null or NaN."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP_ROWS):
            part = batch.slice(at, STEP_ROWS)
            values = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
            yield values[~np.isnan(values).any(axis=1)]


def moments(df: DataFrame, columns: list[str], by: str) -> dict[str, Moments]:
    """The moments of ``columns`` over the complete rows of each value of ``by``, of which there are few.

    Each task adds up its rows and gives one row per value; ``MERGING`` tasks merge those, and the driver the rest.
    """
    names = ["by", "n", "mean", "spread"]
    schema = "by string, n long, mean array<double>, spread array<double>"

    def to_batch(found: dict[str, Moments]) -> pa.RecordBatch:
        arrays = [
            pa.array(list(found), pa.string()),
            pa.array([m.n for m in found.values()], pa.int64()),
            pa.array([m.mean.tolist() for m in found.values()], pa.list_(pa.float64())),
            pa.array([m.spread.ravel().tolist() for m in found.values()], pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Moments] = {}
        for batch in batches:
            group = batch.column(0).dictionary_encode()
            for i, name in enumerate(group.dictionary.to_pylist()):
                mine = batch.filter(pc.equal(group.indices, i)).drop_columns([by])
                for values in complete_rows(iter([mine])):
                    if len(values):
                        mean = values.mean(axis=0)
                        apart = values - mean
                        now = Moments(len(values), mean, apart.T @ apart)
                        found[name] = found[name] + now if name in found else now
        if found:
            yield to_batch(found).append_column("task", pa.array([TaskContext.get().partitionId()] * len(found), pa.int64()))

    def added(rows: Iterator[dict]) -> dict[str, Moments]:
        found: dict[str, Moments] = {}
        for r in rows:
            p = len(r["mean"])
            now = Moments(r["n"], np.array(r["mean"]), np.array(r["spread"]).reshape(p, p))
            found[r["by"]] = found[r["by"]] + now if r["by"] in found else now
        return found

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = added(r for batch in batches for r in batch.select(names).to_pylist())
        if found:
            yield to_batch(found)

    rows = df.filter(F.col(by).isNotNull()).select(F.col(by).cast("string").alias(by), *columns)
    parts = rows.mapInArrow(of_rows, f"{schema}, task long").repartition(MERGING, "task").mapInArrow(merged, schema)
    return added(r.asDict() for r in parts.collect())
