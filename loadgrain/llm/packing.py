"""Packing by power-of-two decomposition: every sequence is one piece of one document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import small_batches, steps
from loadgrain.llm.tokens import encoder, with_end

SCHEMA = "doc_id long, start long, length long, doc_tokens long, bucket int, ids binary"


def piece_lengths(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For documents of ``tokens`` ids: the lengths of all pieces in a row, and how many each has.

    As many pieces of ``longest`` as fit, then the binary digits of the rest from high to low.
    """
    bits = int(longest).bit_length() - 1
    whole, rest = tokens >> bits, tokens & (longest - 1)
    sizes = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    times = np.column_stack([whole, (rest[:, None] & sizes) > 0]).astype(np.int64)
    all_sizes = np.concatenate([[longest], sizes])
    return np.repeat(np.tile(all_sizes, len(tokens)), times.ravel()), times.sum(axis=1)


def pack_powers_of_two(docs: DataFrame, tokenizer: str, end_id: int, longest: int = 4096) -> DataFrame:
    """Cut each document's ids into pieces of power-of-two lengths; each piece is a sequence.

    ``tokenizer`` is the text of a tokenizer's definition, ``longest`` a power of two. Result: one row per
    piece with ``doc_id``, ``start`` (ids of the document before it), ``length``, ``doc_tokens``, ``bucket``
    (log2 of the length), ``ids`` (little-endian unsigned 32-bit), ``sequence_id`` and ``offset``. Nothing
    is padded and no sequence holds two documents; a reader that takes a batch from one bucket has rows
    of equal length. One pass without a shuffle, so no key can be hot.

    A null or empty text is the end id alone, one piece of length 1. A null ``doc_id`` stays null, repeated
    rows are packed each for itself. A table without rows gives no pieces; columns other than ``doc_id``
    and ``text`` are ignored. ``sequence_id`` is unique; it has gaps between the parts of the table.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def pack(batches):
        words = encoder(shared.value)
        for batch in steps(batches):
            ids, starts = with_end(*words.encode(batch.column(1)), end_id)
            count = np.diff(starts)
            length, pieces = piece_lengths(count, longest)
            places = np.concatenate([[0], np.cumsum(length)])
            at = places[:-1] - np.repeat(starts[:-1], pieces)
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(length), [None, pa.py_buffer(places * 4), pa.py_buffer(ids.astype("<u4"))]
            )
            which = pa.array(np.repeat(np.arange(len(count)), pieces))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(which),
                    pa.array(at),
                    pa.array(length),
                    pa.array(np.repeat(count, pieces)),
                    pa.array(np.log2(length).astype(np.int32)),
                    data.cast(pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "bucket", "ids"],
            )

    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    pieces = small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, SCHEMA)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces as Parquet, one folder per bucket of equal lengths."""
    pieces.write.partitionBy("bucket").parquet(path)
