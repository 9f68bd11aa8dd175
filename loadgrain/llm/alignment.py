"""Tokens of two tokenizers aligned byte by byte, and how often the corpus links each two of their ids.

A is a byte-level tokenizer of the tokenizers library, B a sentencepiece model that writes a blank as U+2581. A
text is cut into units at blanks that follow a visible character: A's pre-tokenizer always cuts there, and no
piece of B holds a blank behind another character, so the tokens of a text are those of its units in a row and
a cut between units is a cut of both. Each distinct unit of a batch is aligned once.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.llm.common import runs, small_batches, steps, text_bytes, written

BLANK_MARK = "▁"
# a blank after one of these bytes begins a unit: visible ASCII, or the end of a letter of two bytes
VISIBLE = np.zeros(256, bool)
VISIBLE[33:127] = True
# units remembered by a worker between batches, and units that a tokenizer is asked for at once
MAX_UNITS = 400_000
IN_A_ROW = 2_000
# what may follow an id in the text of groups: one of its own side, the other side, the next group, nothing
ENDS = (",", "|", ";", "")
# linked id pairs of the corpus up to which their counts are sent to every task: 40 MB; beyond it they are joined
MAX_PAIRS = 2_000_000
# rows of one id pair in a task of that join, and how many pairs with more are told apart by a broadcast table (16 MB)
PAIR_ROWS = 500_000
HOT_PAIRS = 1_000_000

ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"

_loaded: dict[tuple[int, int], Aligner] = {}


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_cuts(spans: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens end, from their spans of characters.

    ``place`` has the byte offset of each character. A token that ends where the next begins is cut there. Tokens that
    share a character overlap in their spans; inside it the bytes of the tokens (``sizes``) tell the cuts.
    """
    certain = np.append(spans[1:, 0] >= spans[:-1, 1], True) if len(spans) else np.zeros(0, bool)
    return _refined(place[spans[:, 1]], certain, sizes)


def piece_cuts(spans: np.ndarray, sizes: np.ndarray, lead: int) -> np.ndarray:
    """Byte offsets where pieces end, from their spans of bytes behind a ``lead`` of added bytes.

    A piece with a span of its own is cut at its end. Of the byte tokens of a character all but the last have
    an empty span; they are told by their bytes.
    """
    return _refined(spans[:, 1] + lead, spans[:, 0] < spans[:, 1], sizes)


def _refined(ends: np.ndarray, certain: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The certain ends, and between them the last certain one plus the bytes since."""
    total = np.cumsum(sizes)
    before = np.maximum.accumulate(np.where(certain, np.arange(len(ends)), -1))
    base = np.where(before >= 0, ends[before] - total[before], 0) if len(ends) else ends
    return base + total


class Aligner:
    """The groups and links of whole texts; one for each worker process."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK_MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.cuttable = not any(BLANK_MARK in p.lstrip(BLANK_MARK) for p in pieces)
        # ids as text with what follows them
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.written = pa.array([f"{i}{end}" for i in range(most) for end in ENDS], pa.large_string())
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        # per unit: whether a tokenizer doesn't give back its bytes, tokens of A and B, groups, links
        self.facts = np.zeros((0, 5), np.int64)
        self.pairs = self.codes = self.first_pair = self.first_code = np.zeros(0, np.int64)

    def align(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """``ROWS`` of a batch of ``doc_id`` and ``text``."""
        data, offsets = text_bytes(batch.column(1))
        size = np.diff(offsets)
        n = len(size)
        lead = offsets[:-1] + np.arange(n)
        with_blank = np.empty(len(data) + n, np.uint8)
        mine = np.ones(len(with_blank), bool)
        mine[lead] = False
        with_blank[lead], with_blank[mine] = 32, data
        cut = np.zeros(len(with_blank) + 1, bool)
        if self.cuttable and len(with_blank):
            cut[1:-1] |= (with_blank[1:] == 32) & visible(with_blank)[:-1]
            cut[(offsets[1:] + np.arange(n))[size > 0]] = False  # B adds no blank to a unit that is nothing else
        cut[lead] = cut[-1] = True
        places = np.flatnonzero(cut)
        units = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(with_blank)).dictionary_encode()
        which = self._known(units.dictionary.to_pylist())[units.indices.to_numpy()]
        begins = np.append(np.searchsorted(places, lead), len(which))
        mine = self.facts[which]
        facts = np.add.reduceat(mine, begins[:-1], axis=0) if n else np.zeros((0, 5), np.int64)
        good = (facts[:, 0] == 0) & (size > 0)
        facts[~good] = 0
        use = np.repeat(good, np.diff(begins))
        pairs = gather(self.pairs, self.first_pair[which], mine[:, 4] * use)
        codes = gather(self.codes, self.first_code[which], (mine[:, 1] + mine[:, 2]) * use)
        ends = np.cumsum(facts[:, 1] + facts[:, 2])
        codes[ends[good] - 1] += 1  # nothing follows the last
        texts = self.written.take(pa.array(codes))
        written = np.frombuffer(texts.buffers()[1], np.int64)[: len(codes) + 1]
        groups = pa.LargeStringArray.from_buffers(n, pa.py_buffer(written[np.append(0, ends)].copy()), texts.buffers()[2])
        owner = np.repeat(np.arange(n), facts[:, 4])
        order = np.lexsort((pairs, owner))
        owner, pairs = owner[order], pairs[order]
        at = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (pairs[1:] != pairs[:-1]))) if len(pairs) else order
        times = np.diff(np.append(at, len(pairs)))
        lists = pa.array(np.searchsorted(owner[at], np.arange(n + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                *(pa.array(facts[:, k]) for k in range(1, 5)),
                groups.cast(pa.string()),
                pa.ListArray.from_arrays(lists, pa.array(pairs[at])),
                pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int64))),
            ],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
        )

    def _known(self, units: list[str]) -> np.ndarray:
        """Where each unit stands among those remembered."""
        if len(self.place) > MAX_UNITS:
            self._forget()
        new = [u for u in units if u not in self.place]
        # units that end in a visible character may stand in a row before both tokenizers
        ends = np.array([len(u) > 1 and (33 <= ord(u[-1]) < 127 or 0xC0 <= ord(u[-1]) < 0x800) for u in new], bool)
        ends &= self.cuttable
        joined = [u for u, ok in zip(new, ends, strict=True) if ok]
        alone = [u for u, ok in zip(new, ends, strict=True) if not ok]
        parts = [joined[at : at + IN_A_ROW] for at in range(0, len(joined), IN_A_ROW)] + [[u] for u in alone]
        found = [self._units(part) for part in parts]
        if found:
            self.facts = np.concatenate([self.facts, *(f[0] for f in found)])
            self.pairs = np.concatenate([self.pairs, *(f[1] for f in found)])
            self.codes = np.concatenate([self.codes, *(f[2] for f in found)])
            self.first_pair = np.cumsum(self.facts[:, 4]) - self.facts[:, 4]
            tokens = self.facts[:, 1] + self.facts[:, 2]
            self.first_code = np.cumsum(tokens) - tokens
            self.place.update(zip(joined + alone, range(len(self.place), len(self.place) + len(new)), strict=True))
        return np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Facts of each unit, and linked pairs and written tokens of all in a row."""
        text = "".join(units)
        whole = text.encode()
        a = self.a.encode(text, add_special_tokens=False)
        b = list(self.b.encode(text[1:], return_type="proto").pieces)
        ids_a, ids_b = a.ids, [p.id for p in b]
        bytes_a, bytes_b = [self.bytes_a[i] for i in ids_a], [self.bytes_b[i] for i in ids_b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            if len(units) > 1:
                half = len(units) // 2
                parts = self._units(units[:half]), self._units(units[half:])
                return tuple(np.concatenate(pair) for pair in zip(*parts, strict=True))
            nothing = np.zeros(0, np.int64)
            return np.array([[1, 0, 0, 0, 0]]), nothing, nothing
        place = np.append(np.flatnonzero((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80), len(whole))
        sizes_a, sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (bytes_a, bytes_b))
        ends_a = character_cuts(np.array(a.offsets, np.int64).reshape(-1, 2), sizes_a, place)
        ends_b = piece_cuts(np.array([(p.begin, p.end) for p in b], np.int64).reshape(-1, 2), sizes_b, 1)
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        begins_a, begins_b = np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1])
        low = np.searchsorted(ends_b, begins_a, side="right")
        count = np.searchsorted(begins_b, ends_a, side="left") - low
        pairs = np.repeat(ids_a << 32, count) | ids_b[np.repeat(low, count) + runs(count)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        codes = np.concatenate([ids_a * len(ENDS) + last_a, ids_b * len(ENDS) + 2 * last_b])
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        edges = np.cumsum([len(u.encode()) for u in units])
        facts = np.zeros((len(units), 5), np.int64)
        upto = [np.searchsorted(x, edges, side="right") for x in (ends_a, ends_b, common)]
        upto.append(np.append(0, np.cumsum(count))[upto[0]])
        for k, x in enumerate(upto):
            facts[:, k + 1] = np.diff(x, prepend=0)
        return facts, pairs, codes[order]


def visible(data: np.ndarray) -> np.ndarray:
    """Where a character ends that is surely no white space; characters of more than two bytes are left out."""
    out = VISIBLE[data]
    out[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    return out


def gather(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Stretches of ``values`` in a row."""
    done = np.append(0, np.cumsum(count))
    return values[np.repeat(first - done[:-1], count) + np.arange(done[-1])]


def aligner(definition: str, model: bytes) -> Aligner:
    key = hash(definition), hash(model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(definition, model)
    return _loaded[key]


def aligned(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """One row per document (``ROWS``): tokens of A and B, groups and links, the groups as text, and linked id pairs.

    ``groups`` lists the ids between two common cuts as ``a1,a2|b1;a3|b2,b3``. ``pairs`` holds each linked id pair of the
    document once, A's id times 2**32 plus B's, and ``times`` how many of its links have it. Documents that are null or
    empty, or whose bytes one of the tokenizers doesn't give back, have no tokens and no groups. Rows with null or
    repeated ``doc_id`` are rows of their own; other columns of ``docs`` play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def make(batches):
        ours = aligner(*shared.value)
        for batch in steps(batches):
            yield ours.align(batch)

    return small_batches(docs).select("doc_id", "text").mapInArrow(make, ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links of the corpus that hold it) and ``best`` (no other pair with its B id has more).

    Pairs are added up within each batch of documents before they are shuffled.
    """

    def add(batches):
        for batch in batches:
            pairs, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            distinct, which = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, which, times)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(total)], names=["pair", "n"])

    n = rows.select("pairs", "times").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # the pairs of one id of B are at most as many as A has ids
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return n.withColumn("best", F.col("n") == F.max("n").over(of_b))


def _looked_up(rows: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    """Each document's sums over its links, with all counts at hand in every task."""
    found = counts.toArrow()
    order = np.argsort(found.column("pair").to_numpy())
    known = [found.column(c).to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")]
    shared = rows.sparkSession.sparkContext.broadcast(known)
    schema = rows.select(*keep).schema.add("n_best", "long").add("count_sum", "long")

    def sums(batches):
        pair, n, best = shared.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pairs"))
            size = lists.value_lengths().to_numpy()
            pairs = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(pair, pairs)
            ends = np.concatenate([[0], np.cumsum(size)])
            out = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * n[at])]
            out = [pa.array((x[ends[1:]] - x[ends[:-1]]).astype(np.int64)) for x in out]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *out], names=schema.names)

    return rows.mapInArrow(sums, schema)


def _joined(rows: DataFrame, counts: DataFrame, keep: list[str], pair_rows: int) -> DataFrame:
    """The same by a join; the counts of a pair with many rows are copied, and its rows spread over the copies."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    pair_rows = max(pair_rows, -(-total // HOT_PAIRS))  # so that fewer than HOT_PAIRS have more
    one = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    copies = F.ceil(F.col("n") / pair_rows).cast("int")  # a pair has no more rows than links
    hot = counts.withColumn("copies", copies)
    one = one.join(F.broadcast(hot.filter("copies > 1").select(F.col("pair").alias("pairs"), "copies")), "pairs", "left")
    one = one.withColumn("copy", F.coalesce(F.pmod(F.xxhash64("row"), "copies").cast("int"), F.lit(0)))
    spread = hot.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    met = one.join(spread.select(F.col("pair").alias("pairs"), "copy", "n", "best"), ["pairs", "copy"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    out = rows.join(sums, "row", "left")
    return out.select(*keep, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")))


def align_tokenizers(
    docs: DataFrame, definition: str, model: bytes, max_pairs: int = MAX_PAIRS, pair_rows: int = PAIR_ROWS
) -> DataFrame:
    """Per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    ``n_best`` counts the links whose id pair is the most frequent one of its B id in the corpus, ties included;
    ``count_sum`` adds up the corpus-wide counts over all links. ``groups_sha256`` is that of ``groups`` of ``aligned``,
    empty without tokens. Counts of up to ``max_pairs`` id pairs (counted first) are sent to every task; more are joined.
    """
    rows = aligned(docs, definition, model)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = rows.withColumn("groups_sha256", digest).drop("groups").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "aligned-rows")
    counts = written(pair_counts(rows), "aligned-pairs")
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if counts.count() <= max_pairs:
        return _looked_up(rows, counts, keep)
    return _joined(rows, counts, keep, pair_rows)
