"""Rows dealt into buckets: whole buckets in a task, hot buckets split into pairs of chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import gathered


def split_hot(rows: DataFrame, keys: list[str], member: Column, most: int, weight: Column | None = None) -> DataFrame:
    """Adds ``first``, ``second`` and ``chunk``, so that no bucket of ``keys`` and those has far more than ``2 * most`` rows.

    With a ``weight`` its sum is meant instead of the number of rows.

    A larger bucket is cut into chunks by a hash of ``member``; every two of its chunks, and each with
    itself, become a bucket of their own, so every pair of rows still meets.
    """
    hot = rows.groupBy(*keys).agg(F.sum(F.lit(1) if weight is None else weight).alias("count")).filter(F.col("count") > most)
    hot = hot.select(*keys, F.ceil(F.col("count") / most).cast("int").alias("chunks"))
    rows = rows.join(hot, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(member), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select(
        *[c for c in rows.columns if c not in ("chunks", "other")],
        F.least("chunk", "other").alias("first"),
        F.greatest("chunk", "other").alias("second"),
    )


def whole_buckets(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From rows sorted by ``keys``: tables of whole buckets, and where the buckets begin and end."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in gathered(batches):
        if not batch.num_rows:
            continue
        key = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        end = tuple(k[-1].as_py() for k in key)
        edges = np.flatnonzero(_changes(key))
        begin = int(edges[-1]) + 1 if len(edges) else 0
        if held and (begin or tuple(k[0].as_py() for k in key) != last):
            ready = [*held, batch.slice(0, begin)] if begin else held
            held = []
            yield _bounded(ready, keys)
        elif begin:
            yield _bounded([batch.slice(0, begin)], keys)
        held.append(batch.slice(begin))
        last = end
    if held:
        yield _bounded(held, keys)


def _changes(key: list[pa.Array]) -> np.ndarray:
    change = np.zeros(len(key[0]) - 1, bool)
    for k in key:
        if pa.types.is_integer(k.type) and not k.null_count:
            x = k.to_numpy(zero_copy_only=False)
        else:
            x = k.dictionary_encode(null_encoding="encode").indices.to_numpy()
        change |= x[1:] != x[:-1]
    return change


def _bounded(batches: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    change = np.flatnonzero(_changes([table.column(k).combine_chunks() for k in keys])) + 1
    return table, np.concatenate([[0], change, [table.num_rows]])
