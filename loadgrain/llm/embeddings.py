"""Near-duplicate embeddings by spherical-cap filters from structured random product codes."""

from __future__ import annotations

from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.buckets import split_hot, whole_buckets
from loadgrain.llm.common import small_batches, written
from loadgrain.llm.components import components

# filters that a vector exceeds on average
FILTERS = 20
# and at least, about
LEAST_FILTERS = 16
# vectors that share a label and a filter, on average, if they lay at random
BUCKET = 64
# vectors of a bucket in one task, and in one comparison
BUCKET_ROWS = 100_000
BLOCK = 2048


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, only finite components, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def code_size(n: int) -> int:
    """Words of each half's code: enough filters for about ``BUCKET`` random vectors in a bucket."""
    words = 16
    while words * words * BUCKET < n * FILTERS and words < 8192:
        words *= 2
    return words


@lru_cache(maxsize=16)
def _code(dims: int, words: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation and a random code of unit vectors for each half of the rotated coordinates."""
    rng = np.random.default_rng([seed, dims, words])
    turn, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    half = (dims + 1) // 2
    first, second = rng.standard_normal((words, half)), rng.standard_normal((words, max(dims - half, 1)))
    norm = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    return turn, norm(first), norm(second)


def caps(vectors: np.ndarray, words: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """All filters that each vector exceeds, as (row, filter), rising in both.

    A filter's direction is a word of the first code beside a word of the second; it is exceeded by a score of
    at least the threshold that ``FILTERS`` of all filters exceed on average. For each word of the first
    code, the words of the second that reach the threshold are a prefix of its sorted scores, so only filters
    that are exceeded are listed. A vector that exceeds few has its threshold lowered to its best ``LEAST_FILTERS``.
    """
    dims = vectors.shape[1]
    turn, first, second = _code(dims, words, seed)
    half = first.shape[1]
    least = NormalDist().inv_cdf(1 - min(0.5, FILTERS / words**2)) * np.sqrt(2 / dims)
    best = min(LEAST_FILTERS, words)
    rows, filters = [], []
    for i, vector in enumerate(vectors):  # each by itself: the same scores in every batch
        x = vector @ turn
        one, two = first @ x[:half], second @ (x[half:] if dims > half else np.zeros(1))
        order = np.argsort(-two)
        ranked = two[order]
        tops = np.sort(one)[-best:, None] + ranked[None, :best]
        floor = min(least, np.partition(tops, -best, axis=None)[-best])
        top = np.flatnonzero(one + ranked[0] >= floor)
        reach = np.searchsorted(-ranked, -(floor - one[top]), side="right")
        own = np.concatenate([t * words + order[:r] for t, r in zip(top, reach, strict=True)])
        own.sort()
        rows.append(np.full(len(own), i))
        filters.append(own)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(filters)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, kept as bytes of 64-bit floats."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _spread(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that connect what the marks of a rows-by-columns table connect.

    Both results count rows first, then columns behind them.
    """
    n, m = mask.shape
    left, right = [], []
    open_rows, open_columns = mask.any(axis=1), np.ones(m, bool)
    for start in np.flatnonzero(open_rows):
        if not open_rows[start]:
            continue
        open_rows[start] = False
        front = np.array([start])
        while len(front):
            columns = np.flatnonzero(mask[front].any(axis=0) & open_columns)
            open_columns[columns] = False
            front = np.flatnonzero(mask[:, columns].any(axis=1) & open_rows) if len(columns) else columns
            open_rows[front] = False
            left += [np.full(len(front) + len(columns), start)]
            right += [front, columns + n]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def compare_bucket(
    filter_id: int,
    cid: np.ndarray,
    copies: np.ndarray,
    x: np.ndarray,
    chunk: np.ndarray | None,
    least: float,
    words: int,
    block: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the vectors ``x`` that exceed one filter: links that connect the near ones, and counts of near ones.

    Many pairs meet under several filters. A pair is counted under the smallest filter that both exceed, which
    each task finds anew from the vectors, so no pair is ever written. ``chunk``, if given, holds two values;
    only pairs between them are compared.
    """
    norm = np.sqrt((x * x).sum(axis=1))
    parts = [np.arange(len(x))] if chunk is None else [np.flatnonzero(chunk == c) for c in np.unique(chunk)]
    cuts = [[p[at : at + block] for at in range(0, len(p), block)] for p in parts]
    if len(parts) == 2:
        pairs = [(a, b) for a in cuts[0] for b in cuts[1]]
    else:
        pairs = [(a, b) for i, a in enumerate(cuts[0]) for b in cuts[0][i:]]

    def marks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        near = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= least
        if a is b:
            np.fill_diagonal(near, False)
        return near

    hit, hits = np.zeros(len(x), bool), []
    for a, b in pairs:
        near = marks(a, b)
        if near.any():
            hit[a] |= near.any(axis=1)
            hit[b] |= near.any(axis=0)
            hits.append((a, b))
    if not hits:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    whose = np.flatnonzero(hit)
    row, found = caps(x[whose] / norm[whose][:, None], words)
    row, found = whose[row[found < filter_id]], found[found < filter_id]
    _, place, users = np.unique(found, return_inverse=True, return_counts=True)
    use = users[place] > 1
    row, place = row[use], (np.cumsum(users > 1) - 1)[place[use]]
    shared = int((users > 1).sum())

    def smaller(at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), shared), np.float32)
        back = np.full(len(x), -1)
        back[at] = np.arange(len(at))
        inside = back[row] >= 0
        out[back[row[inside]], place[inside]] = 1
        return out

    left, right, degree = [], [], np.zeros(len(x), np.int64)
    for a, b in hits:
        near = marks(a, b)
        p, q = _spread(near)
        both = np.concatenate([a, b])
        left.append(cid[both[p]])
        right.append(cid[both[q]])
        if shared:
            near &= (smaller(a) @ smaller(b).T) == 0
        degree[a] += near @ copies[b]
        if a is not b:
            degree[b] += near.T @ copies[a]
    own = np.flatnonzero(degree)
    return np.concatenate(left), np.concatenate(right), own, degree[own]


def cap_filter_links(classes: DataFrame, least: float, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Compare the vectors of a label that exceed a common filter.

    ``classes`` has ``cid`` (unique long), ``label``, ``vector`` (bytes of 64-bit floats) and ``copies``.
    Rows of the result are links (``a``, ``b``) with null ``n``, or (``a``, null, ``n``): ``n`` more vectors
    near ``a``, copies counted; each near pair counts once over all rows.
    """
    n = classes.count()
    words, block = code_size(n), BLOCK

    def replicate(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                vectors = part.column(part.schema.get_field_index("vector"))
                size = np.array([len(v) for v in vectors.to_pylist()], np.int64)
                rows, filters = [], []
                for s in np.unique(size):
                    which = np.flatnonzero(size == s)
                    x = _matrix(vectors.take(pa.array(which)))
                    row, found = caps(x / np.sqrt((x * x).sum(axis=1))[:, None], words)
                    rows.append(which[row])
                    filters.append(found)
                if rows:
                    out = part.take(pa.array(np.concatenate(rows)))
                    yield out.append_column("dims", pa.array(size[np.concatenate(rows)] // 8, pa.int32())).append_column(
                        "filter", pa.array(np.concatenate(filters))
                    )

    def compare(batches):
        for rows, bounds in whole_buckets(batches, keys):
            cid, copies = rows.column("cid").to_numpy(), rows.column("copies").to_numpy()
            filters, vectors = rows.column("filter").to_numpy(), rows.column("vector").combine_chunks()
            chunk = rows.column("chunk").to_numpy() if "chunk" in keys_and_more else None
            first = rows.column("first").to_numpy() if chunk is not None else None
            second = rows.column("second").to_numpy() if chunk is not None else None
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                if end - begin < 2:
                    continue
                x = _matrix(vectors.slice(begin, end - begin))
                split = chunk[begin:end] if chunk is not None and first[begin] != second[begin] else None
                if split is not None and len(np.unique(split)) < 2:
                    continue
                a, b, own, more = compare_bucket(
                    int(filters[begin]), cid[begin:end], copies[begin:end], x, split, least, words, block
                )
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([a, cid[begin:end][own]])),
                            pa.array(
                                np.concatenate([b, own * 0]),
                                mask=np.concatenate([np.zeros(len(a), bool), np.ones(len(own), bool)]),
                            ),
                            pa.array(
                                np.concatenate([a * 0, more]),
                                mask=np.concatenate([np.ones(len(a), bool), np.zeros(len(own), bool)]),
                            ),
                        ],
                        names=["a", "b", "n"],
                    )

    keys = ["label", "dims", "filter"]
    keys_and_more = list(keys)
    label = dict(classes.dtypes)["label"]
    copies = classes.select("cid", "label", "vector", "copies").mapInArrow(
        replicate, f"cid long, label {label}, vector binary, copies long, dims int, filter long"
    )
    if n > bucket_rows:  # no bucket holds more than all vectors
        copies = split_hot(copies, keys, F.col("cid"), bucket_rows)
        keys = [*keys, "first", "second"]
        keys_and_more = [*keys, "chunk"]
    dealt = copies.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a long, b long, n long")


def near_embeddings(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Link all vectors of one label with a cosine of at least ``least``; one row for each vector.

    ``n_links`` counts the other vectors that are linked directly, ``component_id`` is the smallest ``vec_id``
    reachable, ``kept`` marks the vector that stays. Equal vectors of a label are one class, compared once.

    Vectors that are null, zero or hold null or non-finite components, and those with a null label, link with
    nothing. Vectors of different lengths don't link. Rows with the same id are judged each for itself; a null
    id is never the smallest, and ``kept`` is false for it. An empty table gives no rows. Columns other
    than ``vec_id``, ``label`` and ``embedding`` are ignored.
    """
    rows = small_batches(vectors).select(F.col("vec_id").cast("long"), "label", "embedding")
    fit = usable(F.col("embedding")) & F.col("label").isNotNull()
    classes = rows.filter(fit).groupBy("label", "embedding")
    classes = classes.agg(F.min("vec_id").alias("smallest"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    def packed(batches):
        for batch in batches:
            data = [np.asarray(v, "<f8").tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary()), batch.column(3)],
                names=["cid", "label", "vector", "copies"],
            )

    label = dict(classes.dtypes)["label"]
    wide = classes.select("cid", "label", "embedding", "copies").mapInArrow(
        packed, f"cid long, label {label}, vector binary, copies long"
    )
    found = written(cap_filter_links(wide, least), "vector-links")
    more = found.filter("n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("more"))
    groups = components(found.filter("n is null").select("a", "b"), "vector-groups")
    classes = classes.join(more, "cid", "left").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    classes = classes.withColumn("root", F.coalesce("root", "cid"))
    smallest = classes.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = classes.join(smallest, "root").select(
        "label", "embedding", "component_id", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    linked = rows.filter(fit).join(classes, ["label", "embedding"])
    alone = rows.filter(~fit).withColumns({"component_id": F.col("vec_id"), "n_links": F.lit(0).cast("long")})
    both = linked.unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return both.select("vec_id", "n_links", "component_id", kept.alias("kept"))
