"""Helpers shared by the operators on training data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loadgrain.plans.scratch import new_folder

# bytes of text that one step of vectorised work takes; a longer single text is a step of its own
STEP_BYTES = 500_000
# rows of a batch between Spark and Python; texts are long
BATCH_ROWS = 1000


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs no work before this point.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """The same table; from now on the session hands at most ``BATCH_ROWS`` rows at a time to Python workers.

    The default of 10,000 documents takes tens of megabytes in each of the JVM, Arrow and Python.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, starts, data = texts.buffers()
    offsets = np.frombuffer(starts, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that memory stays bounded."""
    at = None
    for batch in batches:
        at = batch.schema.get_field_index(column) if at is None else at
        _, offsets = text_bytes(batch.column(at))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The same narrow rows in batches of at least ``rows``, to spare calls for each batch."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths, lengths)
