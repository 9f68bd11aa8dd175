"""Exact substring deduplication of bytes: sparse suffixes in buckets, refined by bucket pointers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import runs, steps, text_bytes, written
from loadgrain.llm.repeats import (
    ROWS,
    Hashes,
    anchor_runs,
    batch_rows,
    covered,
    flat_lists,
    mix,
    one_key,
    repeated,
    texts_of,
    with_ranges,
)

# hash units of the bytes, one for each value
UNITS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def refined(ids: np.ndarray, q: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of ``length / 2`` bytes at each place, and those they point to ``length / 2`` later.

    ``ids`` are the identifiers of the initial buckets of ``q`` bytes. Each round gives a place the identifier
    of the pair (its bucket, the bucket ``q`` bytes later) and doubles ``q``; a round reuses the last one's.
    """
    while 2 * q < length:
        ids = mix(ids[:-q] + mix(ids[q:]))
        q *= 2
    return ids[:-q], ids[q:]


def remove_repeated_bytes(docs: DataFrame, length: int = 100, q: int = 25, first_q: int = 25) -> DataFrame:
    """Remove every byte that lies in ``length`` bytes which also start earlier, in any document.

    Texts are UTF-8 bytes, documents are ordered by ``doc_id``, matches never cross documents, and strings are
    judged on the input. Result: ``doc_id``, ``n_bytes``, ``kept`` (the remaining bytes), and ``begins`` and
    ``ends`` of the maximal removed runs.

    Suffixes start out in buckets of their first bytes, and buckets are refined by sorting on the bucket
    identifiers of later offsets. The suffixes of the first round are the sampled ones (see ``repeats``), in
    buckets of ``q`` bytes, refined by the identifiers of what lies around them. What stays undecided goes
    on as single suffixes: buckets of ``first_q`` bytes, doubled by bucket pointers until two pointers span
    ``length`` (``length`` = ``first_q`` times a power of two). Within a bucket suffixes are sorted by
    the pointer, then by place, so the earliest of each string comes first. Identifiers are hashes of the
    contents, so a pointer is followed without a look-up shuffle; two of them, 128 bits, decide equality.

    Null and empty texts have no bytes and nothing removed. Rows of the same or null ``doc_id`` are documents of
    their own, ordered by text. An empty table gives no rows. Other columns are ignored.
    """
    if not 0 < q <= length <= q + 255:
        raise ValueError("q must lie between 1 and length, and at most 255 below it")
    step = first_q
    while step < length:
        step *= 2
    if step != length or first_q == length:
        raise ValueError("length must be first_q times a power of two, at least 2")

    def sample(batches):
        for batch in steps(batches):
            data, starts = text_bytes(batch.column(1))
            key = batch.column(0).to_numpy()
            seg, first, last, bucket, kind, right = anchor_runs(Hashes(UNITS[data]), starts, length, q)
            yield batch_rows(key[seg], first - starts[seg], last - starts[seg], bucket, kind, right, earliest=True)

    def suffixes(batches):
        for batch in texts_of(batches):
            data, starts = text_bytes(batch.column(2))
            if len(data) < length:
                continue
            here, there = refined(mix(Hashes(UNITS[data]).grams(first_q)), first_q, length)
            low, count = flat_lists(batch.column(3))
            high, _ = flat_lists(batch.column(4))
            doc = np.repeat(np.arange(len(count)), count)
            size = high - low + 1
            doc = np.repeat(doc, size)
            place = np.repeat(low, size) + runs(size)
            at = starts[doc] + place
            yield batch_rows(batch.column(0).to_numpy()[doc], place, place, here[at], there[at], None, earliest=True)

    def cut(batches):
        for batch in texts_of(batches):
            data, starts = text_bytes(batch.column(2))
            low, count = flat_lists(batch.column(3))
            high, _ = flat_lists(batch.column(4))
            ends = np.cumsum(count)
            rows = []
            for i, (begin, end) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                own, part = data[begin:end], slice(ends[i] - count[i], ends[i])
                gone = covered(len(own), low[part], high[part] + length)
                edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                rows.append((len(own), own[~gone].tobytes(), edge[::2].tolist(), edge[1::2].tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))],
                names=["doc_id", "n_bytes", "kept", "begins", "ends"],
            )

    types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    docs = one_key(docs.select(F.col("doc_id").cast("long"), "text"), "suffix-documents")
    found = written(repeated(docs.select("key", "text").mapInArrow(sample, ROWS), earliest=True, apart=True), "suffix-buckets")
    undecided = with_ranges(docs, found.filter("task = 1"), "inner")
    more = repeated(undecided.mapInArrow(suffixes, ROWS), earliest=True, apart=False)
    ranges = found.filter("task = 0").select("key", "low", "high").union(more.select("key", "low", "high"))
    return with_ranges(docs, ranges, "left").mapInArrow(
        cut, "doc_id long, n_bytes long, kept binary, begins array<long>, ends array<long>"
    )
