"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

import itertools
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.buckets import split_hot, whole_buckets
from loadgrain.llm.common import small_batches, steps, written
from loadgrain.llm.components import components, forest
from loadgrain.llm.repeats import one_key
from loadgrain.llm.words import joined_words

# blocks of bits as (bits, radius of the Hamming code's check bits or 0 for all words, differing bits)
# A pair with at most 4 differing bits has few enough in one block, since (1+1) + (1+1) + (0+1) > 4.
BLOCKS = ((25, 4, 1), (25, 4, 1), (14, 0, 0))
# (2+1) + (1+1) > 4: more copies of a fingerprint, far smaller buckets; for very many fingerprints
WIDE_BLOCKS = ((38, 5, 2), (26, 4, 1))
WIDE_FROM = 200_000_000
# fingerprints of a bucket in one task
BUCKET_ROWS = 500_000
SHINGLE_STEP = 100_000
# pairs compared at once
PAIRS = 2_000_000


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (a long of 64 bits) of every row; see ``simhash_components``."""

    def make(batches):
        from xxhash import xxh64_intdigest

        for batch in steps(batches):
            data, begins, ends, first = joined_words(batch.column(1), lower=True)
            words = np.diff(first)
            count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
            owner = np.repeat(np.arange(len(words)), count)
            start = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(len(owner))
            stop = np.minimum(start + shingle, first[1:][owner]) - 1
            view = memoryview(np.ascontiguousarray(data))
            total = np.zeros((len(words), 64), np.int64)
            for at in range(0, len(owner), SHINGLE_STEP):
                part = slice(at, at + SHINGLE_STEP)
                hashes = [
                    xxh64_intdigest(view[a:b], seed)
                    for a, b in zip(begins[start[part]].tolist(), ends[stop[part]].tolist(), strict=True)
                ]
                bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
                own = owner[part]
                edge = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
            majority = np.packbits(total * 2 > count[:, None], axis=1).view(">u8").ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(majority.astype(np.uint64).view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(make, "doc_id long, fingerprint long")


@cache
def _block(bits: int, checks: int, distance: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The syndrome of every word of the code's own bits, and by syndrome what to flip to reach all anchors.

    The code of a block is a Hamming code of ``2**checks - 1`` bits, of covering radius 1, times all words on
    the other bits (``checks`` 0: all words, radius 0). Anchors are its words within radius + ``distance``;
    the nearest stands first.
    """
    own = (1 << checks) - 1
    reach = distance + (checks > 0)
    if not checks:
        flips = [sum(1 << i for i in c) for w in range(reach + 1) for c in itertools.combinations(range(bits), w)]
        return np.zeros(0, np.int64), [np.array(flips, np.int64)]
    by: list[list[tuple[int, int]]] = [[] for _ in range(own + 1)]
    for w in range(reach + 1):
        for c in itertools.combinations(range(own), w):
            s = 0
            for i in c:
                s ^= i + 1
            for v in range(reach - w + 1):
                for d in itertools.combinations(range(own, bits), v):
                    by[s].append((w + v, sum(1 << i for i in c) | sum(1 << i for i in d)))
    return np.arange(1, own + 1), [np.array([f for _, f in sorted(x)], np.int64) for x in by]


def anchors(prints: np.ndarray, blocks: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each replica: its row in ``prints``, its anchor's key, and whether the anchor is the nearest."""
    rows, keys, homes, low = [], [], [], 0
    for number, (bits, checks, distance) in enumerate(blocks):
        word = ((prints >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        columns, flips = _block(bits, checks, distance)
        syndrome = np.zeros(len(word), np.int64)
        for i, column in enumerate(columns):
            syndrome ^= ((word >> i) & 1) * column
        for s in np.unique(syndrome):
            which = np.flatnonzero(syndrome == s)
            anchor = word[which, None] ^ flips[s][None, :]
            rows.append(np.repeat(which, len(flips[s])))
            keys.append(anchor.ravel() | (number << 58))
            homes.append(np.tile(np.arange(len(flips[s])) == 0, len(which)))
        low += bits
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def linked(prints: np.ndarray, home: np.ndarray, bounds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Within each bucket, with homes before visitors: links that connect what lies within ``most`` bits.

    Small buckets are compared pair by pair. In a large one a search spreads from link to link and compares
    only with what has not been reached, so a dense group costs little. Links form a forest either way, and each is one
    of two fingerprints within ``most`` bits.
    """
    size = np.diff(bounds)
    left, right = [], []
    for k in np.flatnonzero(size > 2000):
        at = np.arange(bounds[k], bounds[k + 1])
        while len(at) and home[at[0]]:
            front, at = at[:1], at[1:]
            while len(front) and len(at):
                by = np.full(len(at), -1)
                for x in front:
                    rest = np.flatnonzero(by < 0)
                    by[rest[np.bitwise_count(prints[at[rest]] ^ prints[x]) <= most]] = x
                near = by >= 0
                front, at = at[near], at[~near]
                left.append(by[near])
                right.append(front)
    row = np.arange(len(prints))
    end = np.repeat(bounds[1:], size)
    todo = np.flatnonzero(home & (np.repeat(size, size) <= 2000) & (end > row + 1))
    partners = end[todo] - todo - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(todo):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        count = partners[at:stop]
        a = np.repeat(todo[at:stop], count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        near = np.bitwise_count(prints[a] ^ prints[b]) <= most
        left.append(a[near])
        right.append(b[near])
        at = stop
    if not left:
        return row[:0], row[:0]
    one, other = np.concatenate(left), np.concatenate(right)
    kept = forest(len(prints), one, other)
    return one[kept], other[kept]


def simhash_links(prints: DataFrame, most: int = 4, blocks: tuple | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect the distinct fingerprints with at most ``most`` differing bits.

    The bits are cut into blocks, and a pair has few enough differing bits in one of them. There it meets
    at the anchor nearest to one of the two: a fingerprint is copied to every anchor within the covering radius
    plus the block's share of the bits, and each anchor compares those it is nearest to with all others.
    """
    n = prints.count()
    blocks = blocks or (BLOCKS if n < WIDE_FROM else WIDE_BLOCKS)
    if sum(b for b, _, _ in blocks) != 64 or sum(d + 1 for _, _, d in blocks) <= most:
        raise ValueError("the blocks must have 64 bits and divide the distance")

    def replicate(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                own = batch.column(0).slice(at, 20_000).to_numpy().view(np.uint64)
                row, key, home = anchors(own, blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(own[row].view(np.int64)), pa.array(~home)],
                    names=["anchor", "fingerprint", "visits"],
                )

    def compare(batches):
        for rows, bounds in whole_buckets(batches, keys):
            own = rows.column("fingerprint").to_numpy().view(np.uint64)
            a, b = linked(own, ~rows.column("visits").to_numpy(), bounds, most)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[a].view(np.int64)), pa.array(own[b].view(np.int64))], names=["a", "b"]
                )

    keys = ["anchor"]
    copies = prints.select("fingerprint").mapInArrow(replicate, "anchor long, fingerprint long, visits boolean")
    if n > bucket_rows:  # no bucket holds more than all fingerprints
        copies = split_hot(copies, keys, F.col("fingerprint"), bucket_rows).drop("chunk")
        keys = ["anchor", "first", "second"]
    dealt = copies.repartition(*keys).sortWithinPartitions(*keys, "visits")
    return dealt.mapInArrow(compare, "a long, b long")


def simhash_components(docs: DataFrame, most: int = 4, blocks: tuple | None = None) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, the smallest ``doc_id`` reachable by links.

    A text is lower-cased (A-Z), cut into words at blanks, and hashed in shingles of four words; a bit of the
    fingerprint is set if more than half of the hashes have it. Documents of one fingerprint count as one
    from here on, so that copies never multiply; links join fingerprints with at most ``most`` bits apart.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Fewer than four words
    are one shingle. Rows with the same id are judged each for itself; a null id stays null and is never
    the smallest. A table without rows gives none. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    prints = written(fingerprints(docs), "simhash-prints")
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = components(simhash_links(classes, most, blocks), "simhash-links")
    classes = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    classes = classes.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """The columns of ``docs``, with one row of each component: that with the smallest ``doc_id``, then text."""
    own = [F.col(c).alias(f"_{c}") for c in docs.columns if c not in ("doc_id", "text")]  # none may be named key
    keyed = one_key(docs.select("doc_id", "text", *own), "simhash-documents")
    found = simhash_components(keyed.select(F.col("key").alias("doc_id"), "text"), most)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("key"))
    back = [F.col(c if c in ("doc_id", "text") else f"_{c}").alias(c) for c in docs.columns]
    return keyed.join(kept, "key", "left_semi").select(*back)
