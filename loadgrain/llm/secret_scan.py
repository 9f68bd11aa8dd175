"""Secrets in texts: patterns, and sliding-window entropy of candidate strings; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds of the base scan in order, their patterns, and what a text must hold for one to pass
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# candidate strings of the entropy scan
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# character classes as (kind, pattern of the whole candidate, its characters, least bits in some window)
CLASSES = (
    ("entropy_hex", "^[0-9A-Fa-f]+$", "0123456789ABCDEFabcdef", 3.0),
    ("entropy_base64", "^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 4.0),
)
# candidates that are no secrets: words, numbers, UUIDs, dates, rulers, placeholders
ALLOWED = (
    "^[A-Za-z/_=+-]+$",
    "^[0-9+/_=-]+$",
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "([A-Za-z0-9+/_=-])\\1{9}",
    "(?i)example|placeholder|changeme|dummy",
)
FOUND = "array<struct<start:int,end:int,match:string>>"
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def located(text: Column, pattern: str, hint: str | None = None) -> Column:
    """All matches as (start, end, match), in code points: lengths of matches and of what lies between, added up."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("match")))
    pairs = F.filter(pairs, lambda p: p["match"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out"))

    def add(done: Column, p: Column) -> Column:
        begin = done["at"] + p["gap"]
        end = begin + F.length(p["match"])
        one = F.struct(begin.alias("start"), end.alias("end"), p["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    found = F.aggregate(pairs, start, add, lambda done: done["out"])
    return F.when(text.rlike(hint or pattern), found).otherwise(F.array().cast(FOUND))


def highest_entropy(text: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of ``window`` characters in a row.

    Counts of the characters move with the window: one goes down and one goes up at each step, and the sum
    of c * log2(c) is kept up with them. Null if the text is shorter than the window.
    """
    weight = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)))
    places = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(-1.0).alias("best"),
    )
    steps = F.zip_with(
        places,
        F.concat(F.array_repeat(F.lit(-2), window), places),
        lambda new, old: F.struct(new.alias("new"), old.alias("old")),
    )
    steps = F.filter(steps, lambda s: s["new"].isNotNull())
    steps = F.transform(steps, lambda s, i: F.struct(s["new"].alias("new"), s["old"].alias("old"), i.alias("i")))

    def move(done: Column, s: Column) -> Column:
        down = F.when(s["old"] >= 0, F.get(done["counts"], s["old"])).otherwise(F.lit(0))
        up = F.get(done["counts"], s["new"]) - F.when(s["old"] == s["new"], F.lit(1)).otherwise(F.lit(0))
        total = done["total"] + F.get(weight, up + 1) - F.get(weight, up)
        total = total - F.when(down > 0, F.get(weight, down) - F.get(weight, down - 1)).otherwise(F.lit(0.0))
        counts = F.transform(
            done["counts"],
            lambda c, k: c
            + F.when(k == s["new"], F.lit(1)).otherwise(F.lit(0))
            - F.when(k == s["old"], F.lit(1)).otherwise(F.lit(0)),
        )
        bits = F.lit(math.log2(window)) - total / F.lit(float(window))
        best = F.when(s["i"] >= window - 1, F.greatest(done["best"], bits)).otherwise(done["best"])
        return F.struct(counts.alias("counts"), total.alias("total"), best.alias("best"))

    best = F.aggregate(steps, start, move, lambda done: done["best"])
    return F.when(F.length(text) >= window, best)


def _spans(found: Column, rank: int, kind: str) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    ).cast(SPANS)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``added``: spans (start, rank, end, kind) in code points, sorted by start, then kind.

    ``base`` are the matches of the patterns. ``added`` are candidate strings in which some window of 20
    characters reaches the least entropy of the string's character class; those on the allow-list, and those that
    a base span overlaps, are left out. One pass without a shuffle, in DataFrame functions only.

    A null text is an empty one and has no spans. Rows with the same or a null id are judged each for itself.
    An empty table gives no rows. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id",
        located(F.col("text"), ASSIGN, ASSIGN_HINT).alias("assign"),
        F.when(F.col("text").rlike(ASSIGN_HINT), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).alias("values"),
        located(F.col("text"), ACCESS).alias("access"),
        located(F.col("text"), HEX).alias("hex"),
        located(F.col("text"), CANDIDATE).alias("candidates"),
    )
    kept = F.zip_with("assign", F.coalesce("values", F.array().cast("array<string>")), lambda a, v: F.when(F.length(v) >= 12, a))
    kept = F.filter(kept, lambda a: a.isNotNull())
    base = F.array_sort(
        F.concat(_spans(kept, 0, "assign"), _spans(F.col("access"), 1, "access"), _spans(F.col("hex"), 2, "hex"))
    )

    def suspect(c: Column) -> Column:
        out = ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        for allowed in ALLOWED:
            out = out & ~c["match"].rlike(allowed)
        return out

    rows = rows.select("doc_id", base.alias("base"), "candidates")
    rows = rows.select("doc_id", "base", F.filter("candidates", suspect).alias("candidates"))
    added = [_spans(F.filter("candidates", _in_class(n)), n + 3, CLASSES[n][0]) for n in range(len(CLASSES))]
    return rows.select("doc_id", "base", F.array_sort(F.concat(*added)).alias("added"))


def _in_class(n: int) -> Callable[[Column], Column]:
    """Whether a candidate falls into the n-th class, and in none before it, and has entropy enough for it."""
    _, whole, alphabet, least = CLASSES[n]

    def test(c: Column) -> Column:
        out = c["match"].rlike(whole)
        for _, earlier, _, _ in CLASSES[:n]:
            out = out & ~c["match"].rlike(earlier)
        return out & (highest_entropy(c["match"], alphabet) >= least)

    return test


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
