"""Repeated windows of long sequences: sampled anchors first, single windows only where anchors disagree.

A window of ``length`` units is represented by the smallest of the hashed q-grams inside it, its anchor. Equal
windows have equal anchors at equal places, so windows can only be equal within a bucket of equal anchor
q-grams. Neighbouring windows mostly share an anchor: one row stands for such a run. Runs of a bucket that are
equal as a whole have all their windows equal. Runs of different kinds can share a window only if they agree on a
stretch before the anchor or on one behind it; the first runs of such kinds are taken apart into the windows that
reach over that stretch.
Kinds are told by 64 bits within a bucket of 48, windows by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import STEP_BYTES, gathered, small_batches, written

BASE = 0x9E3779B97F4A7C15 | 1
WHOLE, TAKE_APART = 0, 1
# first runs of a bucket that a task compares; those of a larger bucket are all taken apart
OPEN_RUNS = 200_000
# low bits that hold a place while the smallest hash is sought
PLACE = np.uint64((1 << 28) - 1)

# sums modulo 2**64 alone give equal hashes to some strings that are made for it; sums modulo this prime tell those apart
PRIME = (1 << 31) - 1
PRIME_BASE = 0x2545F491

_powers: dict[str, np.ndarray] = {}
_prime_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(n - 1, 1 << 19).bit_length()
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x)
    return _powers["up"][:n], _powers["down"][:n]


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``PRIME_BASE`` and of its inverse modulo ``PRIME``."""
    if len(_prime_powers.get("up", ())) < n:
        size = 1 << max(n - 1, 1 << 19).bit_length()
        for name, base in (("up", PRIME_BASE), ("down", pow(PRIME_BASE, -1, PRIME))):
            x = np.ones(size, np.uint64)
            done, power = 1, base
            while done < size:
                x[done : 2 * done] = x[:done] * np.uint64(power) % np.uint64(PRIME)
                done, power = 2 * done, power * power % PRIME
            _prime_powers[name] = x
    return _prime_powers["up"][:n], _prime_powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any stretch of a sequence of 64-bit units, from running sums."""

    def __init__(self, units: np.ndarray):
        up, self.down = powers(len(units) + 1)
        self.total = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[: len(units)], out=self.total[1:])
        up, self.prime_down = prime_powers(len(units) + 1)
        terms = (units >> np.uint64(33)) * up[: len(units)]
        terms = (terms & np.uint64(PRIME)) + (terms >> np.uint64(31))  # the same modulo PRIME, and below 2**32
        self.prime_total = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(terms, out=self.prime_total[1:])

    def grams(self, q: int) -> np.ndarray:
        """The hash of the ``q`` units from each place on."""
        return (self.total[q:] - self.total[:-q]) * self.down[: len(self.total) - q]

    def sums(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each stretch as ``grams`` makes it, for short stretches."""
        return (self.total[end] - self.total[begin]) * self.down[begin]

    def stretch(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        own = self.sums(begin, end)
        prime = (self.prime_total[end] - self.prime_total[begin]) % np.uint64(PRIME) * self.prime_down[begin]
        return own ^ mix(prime % np.uint64(PRIME))


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchor_runs(hashes: Hashes, starts: np.ndarray, length: int, q: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with a common anchor: segment, first and last window, bucket, kind, and right side.

    ``starts`` are the segments' begins and the end of the last; no window crosses a segment.
    """
    size = np.diff(starts)
    count = np.maximum(size - length + 1, 0)
    total = int(count.sum())
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(3))
    grams = hashes.grams(q)
    packed = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    low = lowest(packed, length - q + 1)
    window = np.arange(total) + np.repeat(starts[:-1] - (np.cumsum(count) - count), count)
    anchor = (low[window] & PLACE).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    new[np.cumsum(count)[:-1][np.cumsum(count)[:-1] < total]] = True
    at = np.flatnonzero(new)
    first, last = window[at], window[np.append(at[1:], total) - 1]
    anchor = anchor[at]
    kind = mix(hashes.stretch(first, last + length)) ^ mix(((anchor - first) << 20 | (last - first)).astype(np.uint64))
    before = (length - q + 1) // 2
    behind = length - q + 1 - before
    left = side(hashes, anchor - before, anchor, anchor - before >= first)
    right = side(hashes, anchor + q, anchor + q + behind, anchor + q + behind <= last + length)
    # windows that reach over the whole stretch before the anchor; all others reach over that behind it
    wide = np.clip(anchor - before - first + 1, 0, last - first + 1)
    right |= wide.astype(np.uint64) << np.uint64(16)
    bucket = (mix(grams[anchor]) & ~np.uint64(0xFFFF)) | left
    return np.searchsorted(starts, first, side="right") - 1, first, last, bucket, kind, right


def side(hashes: Hashes, begin: np.ndarray, end: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """16 bits of each stretch beside an anchor, 0 where the run doesn't reach that far."""
    out = np.zeros(len(begin), np.uint64)
    at = np.flatnonzero(whole)
    out[at] = mix(hashes.stretch(begin[at], end[at])) % np.uint64(0xFFFF) + np.uint64(1)
    return out


def batch_rows(
    key: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    bucket: np.ndarray,
    kind: np.ndarray,
    right: np.ndarray | None,
    earliest: bool,
) -> pa.RecordBatch:
    """Rows of a batch for the shuffle: of equal rows only the first takes part in the comparison.

    The others, and with ``earliest`` false the first too, are known to be repeated without it. A kind that a
    third of all documents hold therefore reaches its bucket once for each batch.
    """
    place = (low << 32 | (high - low)).astype(np.int64)
    if right is not None:
        place |= right.astype(np.int64) << 8
    order = np.lexsort((place, key, kind, bucket))
    key, place, bucket, kind = (x[order] for x in (key, place, bucket, kind))
    again = np.zeros(len(key), bool)
    again[1:] = (bucket[1:] == bucket[:-1]) & (kind[1:] == kind[:-1])
    known = again.copy()
    if not earliest:
        known[:-1] |= again[1:]
    show, known = np.flatnonzero(~again), np.flatnonzero(known)
    which = np.concatenate([show, known])
    # known rows travel under a key of their own, spread evenly
    at = bucket[which]
    at[len(show) :] = mix(at[len(show) :] + key[known].astype(np.uint64) * np.uint64(BASE) + place[known].astype(np.uint64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(len(which)) < len(show)),
            pa.array(at.view(np.int64)),
            pa.array(kind[which].view(np.int64)),
            pa.array(key[which]),
            pa.array(place[which]),
        ],
        names=["open", "bucket", "kind", "key", "place"],
    )


# ``bucket`` ends with 16 bits of what lies before the anchor; ``place`` is the first window, the number of windows that
# reach over that, 16 bits of what lies behind the anchor, and the number of further windows
ROWS = "open boolean, bucket long, kind long, key long, place long"
RANGES = "key long, low long, high long, edge long, task byte"


def repeated(rows: DataFrame, earliest: bool, apart: bool) -> DataFrame:
    """Ranges of windows (``RANGES``) found repeated (task 0), or to be taken apart (task 1, with ``apart``).

    Rows of a kind after its first are repeated; with ``earliest`` false, the first is too. A bucket streams
    through its task in order of kinds, and only the first rows of its kinds are held, ``OPEN_RUNS`` at most.
    """

    def out(key, place, edge, task, left=None, right=None):
        low, high = place >> 32, (place >> 32) + (place & 0xFF)
        if left is not None:
            middle = low + ((place >> 24) & 0xFF)
            low, high = np.where(left, low, middle), np.where(right, high, middle - 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(key),
                pa.array(low),
                pa.array(high),
                pa.array(edge),
                pa.array(np.full(len(key), task, np.int8)),
            ],
            names=["key", "low", "high", "edge", "task"],
        )

    def twins(group, mark):
        """Whether a mark other than 0 occurs twice in its group."""
        both = group << 16 | mark
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        found = np.zeros(len(both), bool)
        found[order[1:]] |= same
        found[order[:-1]] |= same
        return found & (mark != 0)

    def stream(batches):
        held = None  # the last row, until it is known what follows
        before = None  # bucket and kind of the row before
        firsts = [np.zeros(0, np.int64)] * 4  # the first rows of the kinds in the bucket that goes on
        over = False  # it has too many to be held
        for x in _then_none(batches):
            if x is None and held is None:
                return
            if x is not None and not x.num_rows:
                continue
            now = held if x is None else [c.to_numpy(zero_copy_only=False) for c in x.columns]
            if x is not None and held is not None:
                now = [np.concatenate(pair) for pair in zip(held, now, strict=True)]
            n = len(now[0]) - (x is not None)
            held = None if x is None else [c[n:] for c in now]
            if n:
                is_open, bucket, kind, key, place = now
                gram = bucket >> 16
                new_gram, new = np.ones(len(gram), bool), np.ones(len(gram), bool)
                new_gram[1:] = gram[1:] != gram[:-1]
                new[1:] = new_gram[1:] | (kind[1:] != kind[:-1])
                if before is not None:
                    new_gram[0] = gram[0] != before[0]
                    new[0] = new_gram[0] or kind[0] != before[1]
                before = gram[n - 1], kind[n - 1]
                if is_open[:n].any():
                    known = ~is_open
                    new |= known
                    found = ~new[:n] | known[:n]
                    if not earliest:
                        found[: len(new) - 1] |= ~new[1 : n + 1]
                else:
                    found = np.ones(n, bool)
                at = np.flatnonzero(found)
                if len(at):
                    yield out(key[at], place[at], kind[at], WHOLE)
                if not apart:
                    continue
                at = np.flatnonzero(new[:n] & is_open[:n])
                group = np.concatenate([np.zeros(len(firsts[0]), np.int64), np.cumsum(new_gram[:n])[at]])
                firsts = [np.concatenate([f, c[at]]) for f, c in zip(firsts, (bucket, kind, key, place), strict=True)]
                last = int(new_gram[:n].sum())
                if over and (group == 0).any():
                    mine = group == 0
                    yield out(firsts[2][mine], firsts[3][mine], firsts[1][mine], TAKE_APART)
                    group, firsts = group[~mine], [f[~mine] for f in firsts]
                over &= last == 0
                done = group < last
                ready, group = [f[done] for f in firsts], group[done]
                firsts = [f[~done] for f in firsts]
                if len(firsts[0]) > most:
                    yield out(firsts[2], firsts[3], firsts[1], TAKE_APART)
                    firsts, over = [f[:0] for f in firsts], True
            else:
                ready, group = [f[:0] for f in firsts], np.zeros(0, np.int64)
            if x is None:
                ready = [np.concatenate(pair) for pair in zip(ready, firsts, strict=True)]
                group = np.concatenate([group, np.full(len(firsts[0]), group.max(initial=0) + 1)])
            left, right = twins(group, ready[0] & 0xFFFF), twins(group, (ready[3] >> 8) & 0xFFFF)
            share = np.flatnonzero(left | right)
            if len(share):
                _, edge, key, place = (f[share] for f in ready)
                yield out(key, place, edge, TAKE_APART, left[share], right[share])

    most = OPEN_RUNS
    dealt = rows.repartition(F.shiftright("bucket", 16)).sortWithinPartitions("open", "bucket", "kind", "key", "place")
    return dealt.mapInArrow(stream, RANGES)


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from gathered(batches)
    yield None


def one_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``key``: unique, and in the order of ``doc_id``, then text.

    The key is ``doc_id`` itself unless ids are null or repeated; then documents are sorted and numbered.
    """
    docs = small_batches(docs).drop("key")
    ids = docs.groupBy("doc_id").count().filter("`count` > 1 or doc_id is null")
    if ids.isEmpty():
        return docs.select(F.col("doc_id").cast("long").alias("key"), "*")
    ordered = docs.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return written(ordered.select(F.monotonically_increasing_id().alias("key"), "*"), name)


def with_ranges(docs: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """``docs`` (``key``, ``doc_id``, ``text``) with ``low`` and ``high``, each document's ranges of windows as lists.

    A list is bounded by its text. Texts travel compressed, in a column ``packed``; see ``texts_of``.
    """

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [None if t is None else press(t.as_buffer()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["key", "doc_id", "packed"]
            )

    grouped = ranges.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    grouped = grouped.select("key", F.col("ranges.low").alias("low"), F.col("ranges.high").alias("high"))
    docs = docs.select("key", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    packed = docs.mapInArrow(pack, "key long, doc_id long, packed binary")
    return packed.join(grouped, "key", how).select("key", "doc_id", "packed", "low", "high")


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``with_ranges`` in bounded batches, with ``text`` in place of ``packed``."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        size = np.array([zstandard.frame_content_size(p.as_buffer()) for p in batch.column(2)], np.int64)
        begin = 0
        while begin < batch.num_rows:
            total = np.cumsum(size[begin:])
            end = begin + max(int(np.searchsorted(total, STEP_BYTES, side="right")), 1)
            part = batch.slice(begin, end - begin)
            text = pa.array([unpack(p.as_buffer()) for p in part.column(2)], pa.large_binary()).cast(pa.large_string())
            yield part.set_column(2, "text", text)
            begin = end


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row, and how many each row has; a null list is empty."""
    size = column.value_lengths().fill_null(0).to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), size.astype(np.int64)


def covered(size: int, low: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marks of the places that at least one stretch [low, end) covers."""
    change = np.bincount(low, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(change)[:size] > 0
