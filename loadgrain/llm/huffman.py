"""Token ids in files: canonical length-limited Huffman codes, blocks with bit-offset checkpoints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loadgrain.llm.common import small_batches, steps, written
from loadgrain.llm.tokens import encoder, with_end

# symbols of a block: each block can be decoded from its checkpoint alone
BLOCK = 128
# ids of a shard, a row of the file; a longer document is a shard of its own
SHARD_IDS = 200_000
SHARDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("doc_tokens", T.ArrayType(T.LongType())),
        T.StructField("checkpoints", T.BinaryType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian, 16 or 32 bits as the vocabulary needs, with the end id) of every document.

    The last row of each task has ``counts`` instead: how often each id from 0 on occurs in its documents.
    """

    def encode(batches):
        words = encoder(shared.value)
        kind = "<u2" if len(words.last) <= 1 << 16 and end_id < 1 << 16 else "<u4"
        total = np.zeros(max(len(words.last), end_id + 1), np.int64)
        for batch in steps(batches):
            ids, starts = with_end(*words.encode(batch.column(1)), end_id)
            total += np.bincount(ids, minlength=len(total))
            yield out(batch.column(0), packed(ids.astype(kind), starts), pa.nulls(batch.num_rows, pa.binary()))
        yield out(pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()]))

    def packed(ids, starts):
        data = [None, pa.py_buffer(starts * ids.itemsize), pa.py_buffer(ids)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, data).cast(pa.binary())

    def out(*columns):
        return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "ids", "counts"])

    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(encode, "doc_id long, ids binary, counts binary")


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents, added up from the counts of the tasks."""

    def add(batches):
        total = None
        for batch in batches:
            for counts in batch.column(0):
                own = np.frombuffer(counts.as_buffer(), "<i8")
                total = own.copy() if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    parts = tokens.filter("counts is not null").select("counts").mapInArrow(add, "id long, n long")
    # as many rows as the vocabulary has at most
    found = parts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, np.int64)
    total[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return total


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Lengths of the best prefix code with at most ``longest`` bits, by merging packages level by level.

    ``counts`` are positive; a single symbol gets one bit.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids don't fit into codes of {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(longest):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        levels.append(rank < n)
        items = items[rank]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for own in reversed(levels):
        singles = int(own[:take].sum())
        lengths[:singles] += 1
        take = 2 * (take - singles)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: ids of one length in rising order get consecutive codes."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.longest = int(self.lengths[-1]) if len(ids) else 1
        span = np.left_shift(1, self.longest - self.lengths)
        self.codes = (np.cumsum(span) - span) >> (self.longest - self.lengths)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, high bit first, and the bit offset of each block of ``BLOCK`` ids."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        size = np.zeros(int(self.ids.max()) + 1, np.int64)
        code = np.zeros(len(size), np.uint64)
        size[self.ids], code[self.ids] = self.lengths, self.codes.astype(np.uint64)
        length, value = size[ids], code[ids]
        ends = np.cumsum(length)
        at = ends - length
        word, room = at >> 6, 64 - (at & 63) - length
        out = np.zeros(int(ends[-1] + 63 >> 6) + 1, np.uint64)
        kept = np.where(
            room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64)
        )
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(kept, first)
        over = np.flatnonzero(room < 0)
        out[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: int(ends[-1]) + 7 >> 3], at[::BLOCK]

    def decode(self, bits: bytes, n: int, checkpoints: np.ndarray) -> np.ndarray:
        """All ``n`` ids. The blocks advance side by side, one table look-up for each id."""
        if not n:
            return np.zeros(0, np.uint32)
        span = np.left_shift(1, self.longest - self.lengths)
        symbol = np.zeros(1 << self.longest, np.uint32)
        length = np.zeros(1 << self.longest, np.uint8)
        symbol[: span.sum()], length[: span.sum()] = np.repeat(self.ids, span), np.repeat(self.lengths, span)
        words = np.frombuffer(bits + bytes(16 + -len(bits) % 8), ">u8").astype(np.uint64)
        out = np.empty((BLOCK, len(checkpoints)), np.uint32)
        at, shift, one = checkpoints.astype(np.uint64), np.uint64(64 - self.longest), np.uint64(1)
        last = n - BLOCK * (len(checkpoints) - 1)
        for k in range(BLOCK):
            if k == last:
                at = at[:-1]
            word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            window = (words[word] << off) | ((words[word + 1] >> one) >> (np.uint64(63) - off))
            key = (window >> shift).astype(np.int64)
            out[k, : len(at)] = symbol[key]
            at = at + length[key]
        return out.T.ravel()[:n]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, longest: int = 20) -> None:
    """Write the token ids of all documents, in rising order of ``doc_id``, as Huffman-coded shards.

    ``path/codes`` holds the code's length for each id: lengths are all that a canonical code needs.
    ``path/shards`` holds the bits in rows of about ``SHARD_IDS`` ids with a bit offset for each block.
    Documents are dealt by ranges of ``doc_id``; parts are numbered in that order, and a shard knows how many
    ids of its part come before it.

    A null or empty text is the end id alone. Null ids come first, rows with the same id stand together. A table
    without rows gives files without rows. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    spark = docs.sparkSession
    tokens = written(token_table(docs, tokenizer, end_id), "token-ids")
    counts = count_ids(tokens)
    ids = np.flatnonzero(counts)
    lengths = code_lengths(counts[ids], longest)
    wide = len(encoder(tokenizer).last) > 1 << 16 or end_id >= 1 << 16
    shared = spark.sparkContext.broadcast((ids, lengths))

    def encode(batches):
        code, part, first = Code(*shared.value), TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray]] = []
        n = 0

        def out():
            bits, checkpoints = code.encode(np.concatenate([x for _, x in held]))
            row = {
                "part": part,
                "first": first,
                "n_ids": n,
                "doc_ids": [d for d, _ in held],
                "doc_tokens": [len(x) for _, x in held],
                "checkpoints": checkpoints.astype("<i8").tobytes(),
                "bits": bits,
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for doc, data in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), "<u4" if wide else "<u2")
                if held and n + len(x) > SHARD_IDS:
                    yield out()
                    held, n, first = [], 0, first + n
                held.append((doc.as_py(), x))
                n += len(x)
        if held:
            yield out()

    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("first", pa.int64()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())),
            ("checkpoints", pa.binary()),
            ("bits", pa.binary()),
        ]
    )
    spark.createDataFrame(
        pa.table({"id": pa.array(ids), "length": pa.array(lengths.astype(np.int64))}),
        "id long, length long",
    ).coalesce(1).write.parquet(f"{path}/codes")
    ordered = tokens.filter("ids is not null").select("doc_id", "ids")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(encode, SHARDS).write.parquet(f"{path}/shards")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """All documents of files by ``write_ids``: ``doc_id``, ``start`` (ids of all before it), ``ids``."""
    # as many rows as the vocabulary has at most
    codes = spark.read.parquet(f"{path}/codes").toPandas()
    shared = spark.sparkContext.broadcast((codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)))
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    # one row for each task that wrote, so small enough for one task and a broadcast
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    shards = shards.join(F.broadcast(parts), "part").withColumn("first", F.col("part_start") + F.col("first"))

    def decode(batches):
        code = Code(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                checkpoints = np.frombuffer(row["checkpoints"], "<i8")
                ids = code.decode(row["bits"], row["n_ids"], checkpoints).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(np.asarray(row["doc_tokens"], np.int64))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends[:-1] + row["first"]),
                        pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return shards.select("n_ids", "doc_ids", "doc_tokens", "checkpoints", "bits", "first").mapInArrow(
        decode, "doc_id long, start long, ids binary"
    )
