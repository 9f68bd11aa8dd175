"""Benchmark decontamination by templates: numbers, names and units become slots, windows are hash-joined."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import small_batches, steps, text_bytes, written
from loadgrain.llm.repeats import BASE, Hashes, mix
from loadgrain.llm.suffixes import UNITS as BYTES
from loadgrain.llm.words import joined_words

# fixed values: what counts as a unit behind a number
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb "
    "oz ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years km/h mph m/s dollar dollars cent cents euro euros % percent degree "
    "degrees celsius fahrenheit watt watts kw kwh volt volts hz khz mhz ghz kb mb gb tb".split()
)
NUMBER = re.compile(r"[$€£]?[+-]?[0-9][0-9.,:/]*([a-z%°]*)")
LITERAL, SLOT_NUMBER, SLOT_UNIT, SLOT_NAME, NOTHING = range(5)
# forms of a text: numbers and units as slots; also capitalised words inside sentences; all capitalised words; no slots
PLAIN, NAMES, CAPITALS, WORDS = FORMS = range(4)
SLOT_HASHES = mix(np.arange(1, 6, dtype=np.uint64) * np.uint64(BASE))
EDGES = re.compile(r"^[^\w$€£+%°-]+|[^\w%°]+$")
# item windows up to which the executors get their hashes to look up
LOOK_UP = 1_000_000
WINDOWS = "id long, mark long, form int, length int, hash long, at long, windows long, slots array<string>"


def word_template(word: str) -> tuple[str, int, bool, bool]:
    """The word without punctuation and in lower case, its kind, whether it is capitalised, and ends a sentence."""
    bare = EDGES.sub("", word)
    low = bare.lower()
    ends = word.rstrip("\"')]}»”’").endswith((".", "!", "?", ":", "…"))
    if not low:
        return "", NOTHING, False, ends
    number = NUMBER.fullmatch(low)
    if number and (not number[1] or number[1] in UNITS):
        return low, SLOT_NUMBER, False, ends
    return low, SLOT_UNIT if low in UNITS else LITERAL, bare[0].isupper() and bare[1:].islower(), ends


class Templates:
    """The words of a batch of texts, with their kinds; ``form`` makes templates of them."""

    def __init__(self, texts: pa.Array):
        data, begins, ends, first = joined_words(texts, lower=False)
        blanks = np.ones(len(data), bool)
        blanks[ends] = False
        places = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)
        bytes_ = pa.py_buffer(np.ascontiguousarray(data[blanks]))
        words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(places), bytes_).dictionary_encode()
        found = [word_template(w) for w in words.dictionary.to_pylist()]
        which = words.indices.to_numpy()
        kind = np.array([k for _, k, _, _ in found], np.int64)[which]
        begin = np.zeros(len(which) + 1, bool)
        begin[first] = True
        ends_sentence = np.array([e for _, _, _, e in found], bool)[which]
        opens = begin[:-1].copy()
        opens[1:] |= ends_sentence[:-1]
        # what has no letter or digit is passed over, but a sentence that it ends stays ended
        keep = kind != NOTHING
        empty_before = np.concatenate([[False], ~keep[:-1]]) if len(keep) else keep
        opens |= empty_before
        self.first = np.concatenate([[0], np.cumsum(keep)])[first]
        which, kind, opens = which[keep], kind[keep], opens[keep]
        capital = np.array([c for _, _, c, _ in found], bool)[which]
        behind = np.concatenate([[False], kind[:-1] == SLOT_NUMBER])[: len(kind)]
        edge = np.zeros(len(kind) + 1, bool)
        edge[self.first] = True
        kind = np.where((kind == SLOT_UNIT) & (~behind | edge[:-1]), LITERAL, kind)
        self.kind, self.which, self.words = kind, which, [w for w, _, _, _ in found]
        self.capital, self.opens = capital, opens
        literal = pa.array(self.words, pa.large_string())
        self.literal = _string_hashes(literal)[which] if len(which) else self.first[:0].astype(np.uint64)

    def form(self, number: int) -> Form:
        return Form(self, number)


class Form:
    """One form of all texts, in units: a word, or a run of name words inside a sentence."""

    def __init__(self, of: Templates, number: int):
        kind = np.zeros_like(of.kind) if number == WORDS else of.kind
        if number in (NAMES, CAPITALS):
            kind = np.where((kind == LITERAL) & of.capital & (~of.opens | (number == CAPITALS)), SLOT_NAME, kind)
        name = kind == SLOT_NAME
        goes_on = np.zeros(len(kind), bool)
        goes_on[1:] = name[1:] & name[:-1] & ~of.opens[1:]
        begin = np.flatnonzero(~goes_on)
        self.first = of.first - np.concatenate([[0], np.cumsum(goes_on)])[of.first]
        self.kind, self.of, self.number = kind[begin], of, number
        self.begin = np.append(begin, len(kind))
        self.units = of.literal[begin]
        slot = np.flatnonzero(self.kind)
        self.units[slot] = SLOT_HASHES[self.kind[slot]]
        self.hashes = Hashes(self.units)
        self.literals = np.concatenate([[0], np.cumsum(self.kind == LITERAL)])

    def windows(self, size: int, length: int | None = None) -> tuple[np.ndarray, ...]:
        """Text, first unit, end and hash of each window of ``length`` units, or, without, of ``size`` or the whole text.

        Windows with fewer literal words than half of ``size`` say too little as templates and are left to ``WORDS``.
        """
        own = np.diff(self.first)
        width = np.minimum(own, size) if length is None else np.full(len(own), length)
        count = np.where(own > 0, np.maximum(own - width + 1, 0), 0)
        text = np.repeat(np.arange(len(own)), count)
        at = np.arange(len(text)) + np.repeat(self.first[:-1] - (np.cumsum(count) - count), count)
        stop = at + width[text]
        if self.number != WORDS:
            use = (self.literals[stop] - self.literals[at]) * 2 >= size
            text, at, stop = text[use], at[use], stop[use]
        salt = (stop - at).astype(np.uint64) + np.uint64(self.number << 32)
        return text, at, stop, mix(self.hashes.sums(at, stop) + salt)

    def among(self, size: int, length: int, known: Known) -> tuple[np.ndarray, ...]:
        """Those of ``windows(size, length)`` with a known hash; the few that have one are looked at further."""
        if len(self.units) < length:
            return self.first[:0], self.first[:0], self.first[:0], self.units[:0]
        hashes = mix(self.hashes.grams(length) + np.uint64(length + (self.number << 32)))
        at = known.places(hashes)
        text = np.searchsorted(self.first, at, side="right") - 1
        use = at + length <= self.first[text + 1]
        if self.number != WORDS:
            use &= (self.literals[at + length] - self.literals[at]) * 2 >= size
        return text[use], at[use], at[use] + length, hashes[at[use]]

    def slots(self, at: int, stop: int) -> list[str]:
        """The values of the slots, in order."""
        of, out = self.of, []
        for i in range(at, stop):
            if self.kind[i] != LITERAL:
                out.append(" ".join(of.words[w] for w in of.which[self.begin[i] : self.begin[i + 1]]))
        return out


class Known:
    """Sorted hashes to look up; most others are told by their low bits alone."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = min(max(len(hashes) * 16, 1 << 16).bit_length(), 24)
        self.mask = np.uint64((1 << bits) - 1)
        self.low = np.zeros(1 << bits, bool)
        self.low[hashes & self.mask] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.low[hashes & self.mask])
        some = hashes[at]
        found = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        return at[self.hashes[found] == some]


def _string_hashes(words: pa.Array) -> np.ndarray:
    data, starts = text_bytes(words)
    return mix(Hashes(BYTES[data]).stretch(starts[:-1], starts[1:]) + np.diff(starts).astype(np.uint64) * np.uint64(BASE))


def template_windows(
    rows: DataFrame, size: int, wanted: np.ndarray | None = None, lengths: list[tuple[int, int]] | None = None
) -> DataFrame:
    """The windows of ``rows`` (``id``, ``mark``, ``text``): form, length, hash, place, number of windows here, slots.

    Of items, or with ``lengths`` all of these forms and lengths; with ``wanted`` (sorted hashes) only those with one of them.
    """

    def each(found: Templates, known: Known | None):
        for number in FORMS:
            own = [None] if lengths is None else [n for f, n in lengths if f == number]
            if own:
                form = found.form(number)
                for n in own:
                    yield form, form.windows(size, n) if known is None else form.among(size, n, known)

    def make(batches):
        known = None if shared is None else Known(shared.value)
        for batch in steps(batches):
            found = Templates(batch.column(2))
            for form, (text, at, stop, hashes) in each(found, known):
                total = np.bincount(text, minlength=batch.num_rows)
                if not len(text):
                    continue
                which = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(which),
                        batch.column(1).take(which),
                        pa.array(np.full(len(text), form.number, np.int32)),
                        pa.array((stop - at).astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(at - form.first[text]),
                        pa.array(total[text]),
                        pa.array([form.slots(a, b) for a, b in zip(at, stop, strict=True)], pa.list_(pa.string())),
                    ],
                    names=["id", "mark", "form", "length", "hash", "at", "windows", "slots"],
                )

    shared = None if wanted is None else rows.sparkSession.sparkContext.broadcast(wanted)
    return rows.select("id", "mark", "text").mapInArrow(make, WINDOWS)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = 8, share: float = 0.5, look_up: int = LOOK_UP
) -> DataFrame:
    """Items that documents hold, as ``doc_id``, ``mark`` (a hash of the text), ``item_id``, ``covered``, ``same_values``.

    Texts become templates: words in lower case without punctuation; numbers and units behind a number become typed
    slots, and so do, in two further forms, runs of capitalised words inside a sentence, and wherever they stand, as
    names open sentences too. Windows of ``size`` units of items and documents are joined on their hash, and those of
    the length of each shorter item. Templates with fewer literal words than half of ``size`` are left out. In a fourth
    form all words stay, values included, so that verbatim copies in any case are found, be they of one word.

    Along one alignment of item and document, or several within ``size`` units of each other, ``covered`` is the share
    of the item's windows that are found; the best of at least ``share`` counts, if its slots are consistent:
    equal values of the item stand for equal values of the document, and different ones for different.
    In the form that keeps names as words all windows must be found: another name would hide slots from that test.
    ``same_values`` tells a verbatim copy from a re-parameterised one.

    Up to ``look_up`` item windows (counted first) the executors get their hashes, so that other windows of documents
    are dropped where they arise; beyond it all windows are shuffled. The result is the same.
    """
    columns = [F.xxhash64("text").alias("mark"), F.coalesce("text", F.lit("")).alias("text")]
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), *columns)
    items = written(template_windows(items, size), "template-items")
    wanted = None
    if items.count() <= look_up:
        found = items.select("hash").distinct().toArrow().column(0).to_numpy()  # no more than look_up
        wanted = np.sort(found.astype(np.int64).view(np.uint64))
        if not len(wanted):
            wanted = np.zeros(1, np.uint64)
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("id"), *columns)
    lengths = sorted(tuple(r) for r in items.select("form", "length").distinct().collect())  # at most size of each form
    own = template_windows(rows, size, wanted, lengths)
    items = items.select(
        "hash",
        "form",
        F.col("id").alias("item_id"),
        F.col("mark").alias("item_mark"),
        F.col("at").alias("item_at"),
        F.col("windows").alias("item_windows"),
        F.col("slots").alias("item_slots"),
    )
    pairs = own.select(F.col("id").alias("doc_id"), "mark", "hash", "at", "slots").join(items, "hash")
    values = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    shift = F.col("at") - F.col("item_at")
    near = F.floor(shift / size)  # each two shifts within ``size`` are in one of the overlapping groups
    groups = [F.struct(F.lit(k).alias("kind"), x.cast("long").alias("at")) for k, x in ((0, shift), (1, near), (1, near - 1))]
    pairs = pairs.withColumn("line", F.explode(F.array(*groups)))
    lines = pairs.groupBy("doc_id", "mark", "item_id", "item_mark", "form", "line").agg(
        F.count_distinct("item_at").alias("n"),
        F.max("item_windows").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(values))).alias("values"),  # as many as the item has slots
    )
    lines = lines.withColumn("covered", F.col("n") / F.col("windows"))
    least = F.when(F.col("form") == PLAIN, F.lit(1.0)).otherwise(F.lit(share))
    lines = lines.filter(F.col("covered") >= least)

    def kinds(field: str):
        return F.size(F.array_distinct(F.transform("values", lambda v: v[field])))

    one_to_one = (F.size("values") == kinds("i")) & (F.size("values") == kinds("d"))
    lines = lines.filter(one_to_one).withColumn("same", F.forall("values", lambda v: v["i"] == v["d"]))
    best = lines.groupBy("doc_id", "mark", "item_id").agg(F.max(F.struct("covered", "same")).alias("best"))
    return best.select(
        "doc_id", "mark", "item_id", F.col("best.covered").alias("covered"), F.col("best.same").alias("same_values")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 8, share: float = 0.5) -> DataFrame:
    """All rows and columns of ``docs`` with ``contaminated`` and ``items``, the sorted ids of the items found.

    See ``find_leaks``. A null or empty text or item holds nothing, and without items nothing is contaminated. A null ``doc_id`` or ``item_id`` is treated as a value;
    a null item is not listed in ``items``. Rows are judged by their texts, so repeated rows and ids fare alike. An
    empty table gives no rows. Columns named ``contaminated`` or ``items`` in ``docs`` are replaced.
    """
    leaks = find_leaks(docs, benchmark, size, share)
    leaks = leaks.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    leaks = leaks.select(F.col("doc_id").alias("_leak_id"), F.col("mark").alias("_leak_mark"), "items")
    docs = docs.drop("contaminated", "items")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_leak_id")) & (F.xxhash64(docs["text"]) == F.col("_leak_mark"))
    found = docs.join(leaks, same, "left").withColumn("contaminated", F.col("items").isNotNull())
    items = F.coalesce("items", F.array().cast("array<bigint>"))
    return found.select(*docs.columns, "contaminated", items.alias("items"))
