"""Near copies by the Jaccard similarity of word shingles, found whole.

SimHash fingerprints of the sets meet at the anchors of ``simhash.py``, and their sets are compared. A similarity can be
high with fingerprints further apart, so what the anchors leave unconnected meets by its rare shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.buckets import split_hot, whole_buckets
from loadgrain.llm.common import runs, steps, written
from loadgrain.llm.components import components, forest, roots
from loadgrain.llm.repeats import Hashes, mix, one_key
from loadgrain.llm.simhash import simhash_links
from loadgrain.llm.suffixes import UNITS
from loadgrain.llm.words import joined_words

# bits by which fingerprints differ that meet at an anchor
MOST_BITS = 4
# documents whose shingles are counted to tell common ones; a count from which one is common, and how many are kept
SAMPLED = 20_000
COMMON = 5
MOST_COMMON = 200_000
# rows of a bucket in one task, pairs made at once, and bytes of sets compared at once
BUCKET_ROWS = 500_000
PAIRS = 250_000
SET_BYTES = 8_000_000
# members of all sets of a group that one task compares; pairs and links held back to drop those that come again
GROUP_MEMBERS = 4_000_000
HELD = 500_000
# bits of the sketch that bucket rows carry, and the least that a set has; in buckets of unlike sets they carry more
SMALL_BITS = 256
SMALL = [f"s{i}" for i in range(SMALL_BITS // 64)]
WIDE_BITS = 1024
WIDE = [f"w{i}" for i in range(WIDE_BITS // 64)]
# numbers of 64 bits in the sketches by which groups are split, and the sets of a group that one task compares by them
LONG = 128
LONG_SETS = 16_000


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, sorted within each, and where each text's begin."""
    data, begins, ends, first = joined_words(texts, lower=True)
    length = np.diff(first)
    count = np.where(length > 0, np.maximum(length - words + 1, 1), 0)
    owner = np.repeat(np.arange(len(length)), count)
    start = np.repeat(first[:-1], count) + runs(count)
    stop = np.minimum(start + words, first[1:][owner]) - 1
    a, b = begins[start], ends[stop]
    hashes = mix(Hashes(UNITS[data]).stretch(a, b) + (b - a).astype(np.uint64))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    size = np.bincount(owner[new], minlength=len(length))
    return hashes[new], np.concatenate([[0], np.cumsum(size)])


def digests(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits that tell the sets apart."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(1)))])
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def majorities(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The SimHash of each set: a bit is one if more than half of the members' hashes have it; of an empty set, zero."""
    size = np.diff(first)
    total = np.zeros((len(size), 64), np.int64)
    full = np.flatnonzero(size)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total[full] = np.add.reduceat(bits, first[full], axis=0, dtype=np.int64)
    return np.packbits(total * 2 > size[:, None], axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def sketches(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """For each set the parity of its members by their lowest bits: about one bit for each member.

    Two sets differ in at least as many members as their parities, folded to one length, differ in bits.
    """
    size = np.diff(first)
    bits = own_numbers(size) * 64
    begin = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(size)), size)
    at = begin[owner] + (mix(hashes) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8))
    return [packed[b // 8 : (b + n) // 8].tobytes() for b, n in zip(begin, bits, strict=True)]


def folded(sketch: bytes, numbers: int) -> np.ndarray:
    """A sketch folded to so many numbers of 64 bits; a shorter one is filled up with zeros."""
    own = np.frombuffer(sketch, np.int64)
    if len(own) < numbers:
        return np.concatenate([own, np.zeros(numbers - len(own), np.int64)])
    return np.bitwise_xor.reduce(own.reshape(-1, numbers), axis=0)


def most_apart(n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """In how many members two sets of similarity ``least`` can differ: what they don't share, on both sides."""
    return np.floor((1 - least) / (1 + least) * (n_a + n_b) + 1e-9)


def may_be_near(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the sketches of pairs of sets allow a similarity of ``least``."""
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    out, most = np.zeros(len(a), bool), most_apart(n_a, n_b, least)
    for of_a, of_b in np.unique(sizes, axis=0):
        which = np.flatnonzero((sizes[:, 0] == of_a) & (sizes[:, 1] == of_b))
        length = min(of_a, of_b) // 8
        x, y = (
            np.bitwise_xor.reduce(
                np.frombuffer(b"".join([side[i] for i in which]), np.uint64).reshape(len(which), -1, length), axis=1
            )
            for side in (a, b)
        )
        out[which] = np.bitwise_count(x ^ y).sum(axis=1) <= most[which]
    return out


def prefixes(hashes: np.ndarray, first: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Text and hash of the shingles of each text of which two texts of similarity ``least`` share one.

    Shingles stand in one order for all texts, rare ones first. Two sets share at least ``least`` times the size of
    the larger, so one of the shared is among the first ``n - ceil(least * n) + 1`` of either.
    """
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    level = np.zeros(len(hashes), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], hashes), len(common[0]) - 1)
        level = np.where(common[0][at] == hashes, common[1][at], 0)
    order = np.lexsort((hashes, level, owner))
    use = runs(size) < (size - np.ceil(least * size - 1e-9).astype(np.int64) + 1)[owner]
    return owner[use], hashes[order][use]


def near_by_sketch(sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether sizes and folded sketches of the rows ``a`` and ``b`` allow a similarity of ``least``.

    Sketches of unequal sizes may have been of unequal lengths before they were folded; then only their common fold tells.
    """
    out = np.minimum(n[a], n[b]) >= least * np.maximum(n[a], n[b]) - 1e-9
    most = most_apart(n[a], n[b], least)
    length = np.minimum(own_numbers(n), sketch.shape[1])
    for short in np.unique(length):
        which = np.flatnonzero(out & (np.minimum(length[a], length[b]) == short))
        if not len(which):
            continue
        x, y = (np.bitwise_xor.reduce(sketch[side[which]].reshape(len(which), -1, short), axis=1) for side in (a, b))
        out[which] &= np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1) <= most[which]
    return out


def likely_near(sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Of the pairs that ``near_by_sketch`` allows, those that unlike sets hardly ever are, however large.

    Parities of large unlike sets differ in half of the bits, give or take a few, and that many may be allowed.
    """
    out = near_by_sketch(sketch, n, a, b, least)
    which = np.flatnonzero(out)
    bits = 64 * sketch.shape[1]
    apart = np.bitwise_count((sketch[a[which]] ^ sketch[b[which]]).view(np.uint64)).sum(axis=1)
    out[which] = apart <= bits / 2 - 2 * np.sqrt(bits)
    return out


def own_numbers(size: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits in the sketches of sets."""
    bits = np.full(len(size), SMALL_BITS)
    while (bits < size).any():
        bits = np.where(bits < size, bits * 2, bits)
    return bits // 64


def unlike_pairs(rows: pa.Table, bounds: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within a bucket, of rows sorted by ``n``, whose roots differ and whose sizes and sketches allow ``least``.

    They come in steps of ``PAIRS`` compared, so that no bucket's pairs are ever held together.
    """
    digest, n, root = (rows.column(c).to_numpy() for c in ("digest", "n", "root"))
    sketch = np.stack([rows.column(c).to_numpy() for c in WIDE], axis=1)
    bucket = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    most = np.floor(n / least + 1e-9).astype(np.int64)
    partners = np.searchsorted((bucket << 32) + n, (bucket << 32) + most, side="right") - np.arange(len(n)) - 1
    partners[np.maximum.reduceat(root, bounds[:-1])[bucket] == np.minimum.reduceat(root, bounds[:-1])[bucket]] = 0
    todo = np.flatnonzero(partners)
    total = np.cumsum(partners[todo])
    at = 0
    while at < len(todo):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        count = partners[todo[at:stop]]
        a = np.repeat(todo[at:stop], count)
        b = a + 1 + runs(count)
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        near = near_by_sketch(sketch, n, a, b, least)
        yield digest[a[near]], digest[b[near]]
        at = stop


class Held:
    """Pairs of digests, held back until there are ``HELD`` of them."""

    def __init__(self):
        self.a = self.b = np.zeros(0, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keeps one of equal pairs."""
        batch = _pairs(np.concatenate([self.a, a]), np.concatenate([self.b, b]))
        self.a, self.b = (batch.column(i).to_numpy() for i in (0, 1))
        if len(self.a) > HELD:
            yield self.rest()

    def connect(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keeps what connects the same digests: a link from each to the smallest it is connected with."""
        nodes, at = np.unique(np.concatenate([self.a, a, self.b, b]), return_inverse=True)
        root = roots(len(nodes), *np.split(at, 2))
        up = np.flatnonzero(root != np.arange(len(nodes)))
        self.a, self.b = nodes[root[up]], nodes[up]
        if len(self.a) > HELD:
            yield self.rest()

    def rest(self) -> pa.RecordBatch:
        batch = _pairs(self.a, self.b)
        self.a = self.b = np.zeros(0, np.int64)
        return batch


def long_sketches(sketch: list[bytes], n: np.ndarray) -> np.ndarray:
    """Sketches of one length, of ``LONG`` numbers at most."""
    width = min(LONG, int(own_numbers(n).max(initial=1)))
    return np.stack([folded(x, width) for x in sketch])


def sketch_links(sketch: np.ndarray, n: np.ndarray, root: np.ndarray, part: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows, sorted by ``n``, that connect all pairs of unlike roots whose sizes and sketches allow ``least``.

    If there are two parts, only pairs of both are compared, and those connected by then are not compared again.
    """
    numbers = np.minimum(own_numbers(n), sketch.shape[1])
    folds = {short: np.bitwise_xor.reduce(sketch.reshape(len(n), -1, short), axis=1) for short in np.unique(numbers)}
    two = len(np.unique(part)) > 1
    group = np.arange(len(n))
    partners = np.searchsorted(n, np.floor(n / least + 1e-9), side="right") - group - 1
    total = np.cumsum(partners)
    left, right = [group[:0]], [group[:0]]
    at = 0
    while at < len(n):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        a = np.repeat(np.arange(at, stop), partners[at:stop])
        b = a + 1 + runs(partners[at:stop])
        use = (root[a] != root[b]) & (group[a] != group[b])
        if two:
            use &= part[a] != part[b]
        a, b = a[use], b[use]
        for short, fold in folds.items():  # the first of a pair is the smaller, so its sketch is the shorter
            of = np.flatnonzero(numbers[a] == short)
            for begin in range(0, len(of), SET_BYTES // (8 * int(short))):
                x, y = (side[of[begin : begin + SET_BYTES // (8 * int(short))]] for side in (a, b))
                apart = np.bitwise_count((fold[x] ^ fold[y]).view(np.uint64)).sum(axis=1)
                near = apart <= most_apart(n[x], n[y], least)
                x, y = x[near], y[near]
                kept = forest(len(n), group[x], group[y])
                left.append(x[kept])
                right.append(y[kept])
                group = roots(len(n), group[x], group[y])[group]
        at = stop
    return np.concatenate(left), np.concatenate(right)


def near_links(
    sets: list[np.ndarray], root: np.ndarray, part: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near among sorted ``sets``: all pairs of unlike roots that share a rare shingle are compared.

    If there are two parts, only pairs of both are. Pairs come in steps of about ``PAIRS``, all of a set in one step; what
    is connected by then is not compared again.
    """
    n = np.array([len(x) for x in sets], np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    flat = np.concatenate(sets)
    full = sketches(flat, first)
    wide = np.array([folded(x, len(WIDE)) for x in full], np.int64).reshape(-1, len(WIDE))
    owner, rare = prefixes(flat, first, least, common)
    order = np.lexsort((owner, rare))
    members, keys = owner[order], rare[order]
    # the members of the bucket after each own row, by the row's place
    ends = np.searchsorted(keys, keys, side="right")
    by_owner = np.argsort(members, kind="stable")
    places, count = by_owner, (ends - np.arange(len(keys)) - 1)[by_owner]
    stops = np.searchsorted(members[by_owner], np.arange(len(sets)), side="right")
    total = np.concatenate([[0], np.cumsum(count)])[stops]
    two = len(np.unique(part)) > 1
    root = np.unique(root, return_inverse=True)[1]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(sets):
        stop = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        rows = slice(stops[at - 1] if at else 0, stops[stop - 1])
        a = np.repeat(members[places[rows]], count[rows])
        b = members[np.repeat(places[rows] + 1, count[rows]) + runs(count[rows])]
        use = root[a] != root[b]
        if two:
            use &= part[a] != part[b]
        pairs = np.unique(a[use] * len(sets) + b[use])
        a, b = pairs // len(sets), pairs % len(sets)
        near = near_by_sketch(wide, n, a, b, least)
        a, b = a[near], b[near]
        near = may_be_near([full[i] for i in a], [full[i] for i in b], n[a], n[b], least)
        a, b = a[near], b[near]
        begin = 0
        size = np.cumsum(n[a] + n[b])
        while begin < len(a):
            done = size[begin - 1] if begin else 0
            end = max(int(np.searchsorted(size, done + SET_BYTES // 8, side="right")), begin + 1)
            x, y = a[begin:end], b[begin:end]
            begin = end
            open_ = root[x] != root[y]
            x, y = x[open_], y[open_]
            if len(x):
                both = shared_members([sets[i] for i in x], [sets[i] for i in y])
                found = both >= least * (n[x] + n[y] - both) - 1e-9
                x, y = x[found], y[found]
                kept = forest(len(sets), root[x], root[y])
                left.append(x[kept])
                right.append(y[kept])
                root = roots(len(sets), root[x], root[y])[root]
        at = stop
    return np.concatenate(left), np.concatenate(right)


def shared_members(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets share."""
    owner = np.concatenate([np.repeat(np.arange(len(x)), [len(s) for s in side]) for side in (x, y)])
    flat = np.concatenate([*x, *y])
    order = np.lexsort((flat, owner))
    owner, flat = owner[order], flat[order]
    again = (owner[1:] == owner[:-1]) & (flat[1:] == flat[:-1])
    return np.bincount(owner[1:][again], minlength=len(x))


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _common(docs: DataFrame, n: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many texts hold, and how common each is; any list gives the same result."""

    def make(batches):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(batch.column(0), words)[0].view(np.int64))], names=["shingle"])

    if n > SAMPLED:
        docs = docs.filter(F.pmod(F.xxhash64("key"), F.lit(n)) < SAMPLED)
    counts = docs.select("text").mapInArrow(make, "shingle long").groupBy("shingle").count().filter(F.col("count") >= COMMON)
    found = counts.orderBy(F.desc("count"), "shingle").limit(MOST_COMMON).toArrow()
    hashes = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log2(found.column("count").to_numpy()[order]).astype(np.int64)


def anchored_pairs(classes: DataFrame, most: int, bucket_rows: int) -> DataFrame:
    """Pairs ``a``, ``b`` (digests) that connect the sets whose fingerprints are at most ``most`` bits apart."""
    prints = written(classes.groupBy("fingerprint").agg(F.min("digest").alias("least")), "near-prints")
    links = simhash_links(prints.select("fingerprint"), most, bucket_rows=bucket_rows).distinct()
    for side in ("b", "a"):
        links = links.join(prints.select(F.col("fingerprint").alias(side), F.col("least").alias(f"least_{side}")), side)
    apart = links.select(F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b"))
    same = classes.join(prints, "fingerprint").filter("digest <> least")
    return apart.union(same.select(F.col("least").alias("a"), F.col("digest").alias("b")))


def copy_links(
    docs: DataFrame, classes: DataFrame, words: int, least: float, bucket_rows: int = BUCKET_ROWS, most: int = MOST_BITS
) -> DataFrame:
    """Links ``a``, ``b`` (digests) that connect the sets of shingles with a similarity of at least ``least``.

    Sets whose fingerprints are at most ``most`` bits apart are found at common anchors and compared; what they connect
    is not compared again. For the rest, texts that share one of their rare shingles meet. First each is compared with
    the smallest, the largest and the next one there, so that a group of copies becomes one in a few comparisons
    for each; then every pair that is not connected by then is compared. Where they meet, rows carry a small sketch of their sets, and only pairs are written whose
    sizes and sketches make the similarity likely; full sketches then leave few but the pairs that have it, for which the sets are sent.
    Of the rest no pairs are written: sets of which sizes and wider sketches allow the similarity are connected to groups, which
    long sketches split; a set is sent once to its group, and there all pairs that share a rare shingle are compared.
    ``classes`` has a row for each set: its digest, a key of ``docs``, size, fingerprint and sketches.
    """
    spark = docs.sparkSession
    n = classes.count()
    shared = spark.sparkContext.broadcast(_common(docs, n, words))
    keys, chunks = ["shingle"], ["group", "first", "second"]

    def prefix(batches):
        for batch in steps(batches):
            hashes, first = shingle_sets(batch.column(0), words)
            owner, some = prefixes(hashes, first, least, shared.value)
            arrays = [some.view(np.int64), digests(hashes, first)[owner], np.diff(first)[owner].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["shingle", "digest", "n"])

    def meeting(batches):
        for rows, bounds in whole_buckets(batches, keys):
            size = np.diff(bounds)
            yield from rows.filter(pa.array(np.repeat(size > 1, size))).to_batches()

    def some_pairs(batches):
        held = Held()
        for rows, bounds in whole_buckets(batches, keys):
            digest, n, root = (rows.column(c).to_numpy() for c in ("digest", "n", "root"))
            small = np.stack([rows.column(c).to_numpy() for c in SMALL], axis=1)
            row, size = np.arange(len(n)), np.diff(bounds)
            last = np.repeat(bounds[1:] - 1, size)
            # the next way is only gone where the one before shows the row to be unlike
            for one, other in ((np.repeat(bounds[:-1], size), row), (row, np.minimum(row + 1, last)), (row, last)):
                a, b = one[row], other[row]
                known = (root[a] == root[b]) & (a != b)
                near = likely_near(small, n, a, b, least) & (a != b) & ~known
                yield from held.add(digest[a[near]], digest[b[near]])
                row = row[~near & ~known]
                if not len(row):
                    break
        yield held.rest()

    def mixed(batches):
        for rows, bounds in whole_buckets(batches, keys):
            root = rows.column("root").to_numpy()
            unlike = np.maximum.reduceat(root, bounds[:-1]) != np.minimum.reduceat(root, bounds[:-1])
            yield from rows.filter(pa.array(np.repeat(unlike, np.diff(bounds)))).to_batches()

    def may_connect(batches):
        held = Held()
        for rows, bounds in whole_buckets(batches, keys):
            for a, b in unlike_pairs(rows, bounds, least):
                yield from held.connect(a, b)
        yield held.rest()

    def split_group(batches):
        for rows, bounds in whole_buckets(batches, chunks):
            digest, n, root, chunk = (rows.column(c).to_numpy() for c in ("digest", "n", "root", "chunk"))
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                own = slice(begin, end)
                sketch = long_sketches(rows.column("sketch").slice(begin, end - begin).to_pylist(), n[own])
                a, b = sketch_links(sketch, n[own], root[own], chunk[own], least)
                yield _pairs(digest[own][a], digest[own][b])

    def compare_group(batches):
        for rows, bounds in whole_buckets(batches, chunks):
            digest, root, chunk = (rows.column(c).to_numpy() for c in ("digest", "root", "chunk"))
            own = rows.column("own")
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in own.slice(begin, end - begin)]
                a, b = near_links(sets, root[begin:end], chunk[begin:end], least, shared.value)
                yield _pairs(digest[begin:end][a], digest[begin:end][b])

    def screen(batches):
        for batch in batches:
            n_a, n_b, a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("n_a", "n_b", "sketch_a", "sketch_b"))
            near = may_be_near(a.to_pylist(), b.to_pylist(), n_a.to_numpy(), n_b.to_numpy(), least)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    def sets(batches):
        for batch in steps(batches):
            hashes, first = shingle_sets(batch.column(1), words)
            own = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["digest", "own"])

    def compare(batches):
        for whole in batches:
            size = np.cumsum([len(x.as_buffer()) + len(y.as_buffer()) for x, y in zip(whole.column(2), whole.column(3), strict=True)])
            begin = 0
            while begin < whole.num_rows:
                done = int(size[begin - 1]) if begin else 0
                end = max(int(np.searchsorted(size, done + SET_BYTES, side="right")), begin + 1)
                batch = whole.slice(begin, end - begin)
                x, y = ([np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column(i)] for i in (2, 3))
                both = shared_members(x, y)
                use = both >= least * (np.array([len(s) for s in x]) + np.array([len(s) for s in y]) - both) - 1e-9
                yield batch.select(["a", "b"]).filter(pa.array(use, pa.bool_()))
                begin = end

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        texts = docs.select("key", "text").join(classes.select("digest", "key").join(wanted, "digest"), "key")
        return written(texts.select("digest", "text").mapInArrow(sets, "digest long, own binary"), f"near-sets-{name}")

    def alike(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.distinct()
        for side in ("b", "a"):
            own = classes.select(
                F.col("digest").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
            )
            pairs = pairs.join(own, side)
        pairs = written(pairs.mapInArrow(screen, "a long, b long"), f"near-pairs-{name}")
        own = sets_of(pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct(), name)
        for side in ("b", "a"):
            pairs = pairs.join(own.select(F.col("digest").alias(side), F.col("own").alias(f"own_{side}")), side)
        both = pairs.select("a", "b", "own_a", "own_b")
        return written(both.mapInArrow(compare, "a long, b long"), f"near-links-{name}")

    def rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
        found = found.withColumnRenamed("node", "digest")
        return rows.join(found, "digest", "left").withColumn("root", F.coalesce("root", "digest"))

    def grouped(links: DataFrame, found: DataFrame, name: str) -> DataFrame:
        groups = components(links, f"{name}-links").select(F.col("node").alias("digest"), F.col("root").alias("group"))
        return written(rooted(groups.join(classes.select("digest", "n"), "digest"), found), name)

    anchored = alike(anchored_pairs(classes, most, bucket_rows), "anchored")
    some = rooted(classes.select("digest", *SMALL), components(anchored, "near-roots-anchored"))
    rows = docs.select("text").mapInArrow(prefix, "shingle long, digest long, n long").distinct()
    if n > bucket_rows:  # no bucket holds more than all sets
        rows = split_hot(written(rows, "near-rows"), keys, F.col("digest"), bucket_rows).drop("chunk")
        keys = ["shingle", "first", "second"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "n", "digest")
    met = dealt.mapInArrow(meeting, dealt.schema)
    met = written(met.join(some, "digest"), "near-rows-met")
    order = met.repartition(*keys).sortWithinPartitions(*keys, "n", "digest")
    links = anchored.union(alike(order.mapInArrow(some_pairs, "a long, b long"), "some"))
    found = components(links, "near-roots")
    dealt = rooted(met.drop(*SMALL, "root"), found).repartition(*keys).sortWithinPartitions(*keys)
    left = written(dealt.mapInArrow(mixed, dealt.schema), "near-rows-left")
    left = left.join(classes.select("digest", *WIDE), "digest").repartition(*keys).sortWithinPartitions(*keys, "n", "digest")
    # sets that sketches leave open are connected to groups; all sketches of a group split it, and each set goes to its group once
    joined = left.mapInArrow(may_connect, "a long, b long")
    loose = grouped(joined, found, "near-groups-loose")
    rows = split_hot(loose, ["group"], F.col("digest"), LONG_SETS)
    rows = rows.join(classes.select("digest", F.col("sketch")), "digest")
    rows = rows.repartition(*chunks).sortWithinPartitions(*chunks, "n", "digest")
    groups = grouped(rows.mapInArrow(split_group, "a long, b long"), found, "near-groups")
    own = sets_of(groups.select("digest"), "groups")
    rows = split_hot(groups, ["group"], F.col("digest"), GROUP_MEMBERS, F.col("n")).drop("n").join(own, "digest")
    rows = rows.repartition(*chunks).sortWithinPartitions(*chunks)
    return links.union(written(rows.mapInArrow(compare_group, "a long, b long"), "near-links-groups"))


def drop_near_copies(docs: DataFrame, words: int = 5, least: float = 0.8, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The columns of ``docs``, with one row of each group of near copies: that with the smallest ``doc_id``, then text.

    A text is lower-cased (A-Z), cut into words at blanks, and taken as the set of its shingles of ``words`` words;
    fewer words are one shingle. Texts are near copies if the Jaccard similarity of their sets is at least ``least``,
    whether their fingerprints are close or not, and groups are their connected components. All such pairs are found, none is left to chance but that hashes
    of 64 bits stand for shingles. Null, empty and blank texts are copies of each other. A table without rows gives none.
    """
    own = [F.col(c).alias(f"_{c}") for c in docs.columns if c not in ("doc_id", "text")]  # none may be named key
    keyed = one_key(docs.select("doc_id", "text", *own), "near-documents")

    def make(batches):
        for batch in steps(batches):
            hashes, first = shingle_sets(batch.column(1), words)
            own = sketches(hashes, first)
            arrays = [batch.column(0), pa.array(digests(hashes, first)), pa.array(np.diff(first))]
            arrays += [pa.array(majorities(hashes, first)), pa.array(own, pa.binary())]
            for names in (SMALL, WIDE):
                numbers = np.array([folded(x, len(names)) for x in own], np.int64).reshape(-1, len(names))
                arrays += [pa.array(numbers[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "digest", "n", "fingerprint", "sketch", *SMALL, *WIDE])

    schema = f"key long, digest long, n long, fingerprint long, sketch binary, {', '.join(f'{c} long' for c in (*SMALL, *WIDE))}"
    prints = keyed.select("key", "text").mapInArrow(make, schema)
    # texts of one digest have one set, so any of their sketches will do
    same = [F.min_by(c, "key").alias(c) for c in ("n", "fingerprint", "sketch", *SMALL, *WIDE)]
    classes = written(prints.groupBy("digest").agg(F.min("key").alias("key"), *same), "near-classes")
    found = components(copy_links(keyed, classes, words, least, bucket_rows), "near-copies").withColumnRenamed("node", "digest")
    classes = classes.select("digest", "key").join(found, "digest", "left")
    kept = classes.groupBy(F.coalesce("root", "digest")).agg(F.min("key").alias("key")).select("key")
    back = [F.col(c if c in ("doc_id", "text") else f"_{c}").alias(c) for c in docs.columns]
    return keyed.join(kept, "key", "left_semi").select(*back)
