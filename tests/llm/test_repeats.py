"""Repeated passages and bytes against plain Python."""

from __future__ import annotations

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from loadgrain.llm import repeats
from loadgrain.llm.passages import remove_repeated_passages
from loadgrain.llm.suffixes import refined, remove_repeated_bytes


def passages(df, window, q):
    found = remove_repeated_passages(df, window=window, q=q)
    return sorted(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect())


def suffixes(df, length, q, first_q):
    found = remove_repeated_bytes(df, length, q, first_q)
    assert all(len(r["begins"]) == len(r["ends"]) for r in found.collect())
    out = found.select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("begins"), F.sha2("kept", 256)
    )
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("seed, window, q", [(1, 6, 3), (2, 5, 5), (3, 8, 2), (4, 7, 1)])
def test_passages(docs, seed, window, q):
    rows = plain.texts_with_copies(seed, 40)
    assert passages(docs(rows), window, q) == sorted(plain.repeated_words(rows, window))


@pytest.mark.parametrize("seed, length, q, first_q", [(5, 20, 8, 10), (6, 16, 16, 4), (7, 12, 1, 6), (8, 24, 7, 3)])
def test_bytes(docs, seed, length, q, first_q):
    rows = plain.texts_with_copies(seed, 30)
    assert suffixes(docs(rows), length, q, first_q) == plain.repeated_bytes(rows, length)


def test_edges(docs, spark):
    """Repeated and null ids, one word over and over, copies, a text of exactly one window, no rows."""
    line = " ".join(f"w{i}" for i in range(35))
    rows = [(1, line), (1, line), (None, line), (2, "a " * 500), (3, line + " x"), (4, "y " + line), (5, line[:-1])]
    got = remove_repeated_passages(docs(rows))
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got.collect()) == [
        (0, 35), (1, 35), (1, 35), (2, 500), (3, 35), (4, 35), (5, 0)
    ]
    got = remove_repeated_bytes(docs(rows))
    removed = sorted((r["doc_id"] or 0, r["n_bytes"] - len(r["kept"])) for r in got.collect())
    full = len(line)
    assert removed == [(0, 0), (1, full), (1, full), (2, 998), (3, full), (4, full), (5, full - 1)]
    for df in (docs([]), docs([(1, None)]), docs([(1, "")])):
        assert passages(df, 35, 15) == [(1, 0, 0, plain.sha(b""))][: df.count()]
        assert suffixes(df, 100, 25, 25) == [(1, 0, 0, 0, plain.sha(b""))][: df.count()]
    with pytest.raises(ValueError):
        remove_repeated_bytes(docs([]), length=100, first_q=30)


def test_long_text_and_many_copies(docs):
    """A text over many steps, and a group of copies and near copies."""
    rng = np.random.default_rng(5)
    words = [f"t{i}" for i in rng.integers(0, 5000, 60_000)]
    long = " ".join(words)
    rows = [(i, long if i in (3, 9) else " ".join([*words[100:200], f"z{i}", *words[200:300]])) for i in range(60)]
    assert passages(docs(rows), 35, 15) == sorted(plain.repeated_words(rows, 35))
    got = suffixes(docs(rows), 100, 25, 25)
    want = plain.repeated_bytes([(i, t) for i, t in rows if i != 9], 100)
    assert [r for r in got if r[0] != 9] == want
    assert next(r[2] for r in got if r[0] == 9) == len(long.encode())


def test_large_buckets_are_taken_apart(docs, monkeypatch):
    rows = plain.texts_with_copies(11, 40)
    df = docs(rows)
    want = passages(df, 6, 3), suffixes(df, 20, 8, 10)
    stream = repeats.OPEN_RUNS
    monkeypatch.setattr(repeats, "OPEN_RUNS", 1)
    assert repeats.OPEN_RUNS != stream
    assert (passages(df, 6, 3), suffixes(df, 20, 8, 10)) == want


def test_pointers_reuse_the_round_before():
    ids = np.arange(1, 41, dtype=np.uint64)
    here, there = refined(ids, 5, 20)
    assert len(here) == len(there) == 40 - 5 - 10
    assert (here[10:] == there[:-10]).all()


def made_to_collide(n):
    """Two strings of ``n`` letters that sums of powers modulo 2**64 can't tell apart, whatever the base."""
    signs = ["ab"[bin(i).count("1") % 2] for i in range(n)]
    return "".join(signs), "".join("ba"["ab".index(c)] for c in signs)


def test_hashes_of_strings_made_to_collide():
    a, b = (np.frombuffer(x.encode(), np.uint8).astype(np.uint64) << np.uint64(40) for x in made_to_collide(4096))
    whole = repeats.Hashes(np.concatenate([a, b]))
    begin = np.array([0, 4096])
    sums = whole.total[begin + 4096] - whole.total[begin]
    assert (sums * whole.down[begin])[0] == (sums * whole.down[begin])[1]
    found = whole.stretch(begin, begin + 4096)
    assert found[0] != found[1]
    again = repeats.Hashes(np.concatenate([b[:77], a, b])).stretch(begin + 77, begin + 77 + 4096)
    assert again.tolist() == found.tolist()


def test_words_made_to_collide_are_kept(docs):
    """Two words of 1,024 letters among 34 others: different passages, none is removed."""
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(i, f"{rest} {word}") for i, word in enumerate(made_to_collide(1024))]
    assert passages(docs(rows), 35, 15) == sorted(plain.repeated_words(rows, 35))
    assert all(r[2] == 0 for r in passages(docs(rows), 35, 15))
