"""The stage on near-duplicates against the Jaccard similarity of all pairs of texts."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import plain
import pyarrow as pa
import pytest

from loadgrain.llm import near_copies
from loadgrain.llm.near_copies import drop_near_copies


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = plain.WORD.findall(low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def first_of_each(rows):
    """``rows`` in order of doc_id, then text."""
    sets = [shingles(t) for _, t in rows]
    near = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
    ]
    top = plain.roots(len(rows), near)
    return [rows[i] for i in sorted(set(top))], near, top


def changed_copies(seed, n):
    """Texts of 1 to 400 words with copies of copies, in which some words are others."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 3, 5, 8, 30, 120, 400]))]
        if out and rng.random() < 0.7:
            words = rng.choice(out)[1].split()
            for _ in range(rng.randint(0, len(words) // 40 + 1)):
                words[rng.randrange(len(words))] = rng.choice(["A", f"w{rng.randrange(3000)}"])
            if rng.random() < 0.3:
                words = words[: max(1, len(words) * 9 // 10)] + ["the", "same", "line", "below", "all", "texts"]
        out.append((i, " ".join(words)))
    return [*out, (n, None), (n + 1, ""), (n + 2, " \n")]


@pytest.mark.parametrize("bucket_rows", [500_000, 10])
def test_all_near_copies_are_found(docs, bucket_rows):
    rows = changed_copies(5, 250)
    want, near, _ = first_of_each(rows)
    prints = [plain.fingerprint(t) for _, t in rows]
    assert sum(bin(prints[i] ^ prints[j]).count("1") > 4 for i, j in near) > 30
    got = drop_near_copies(docs(rows), bucket_rows=bucket_rows).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == want


def test_the_stage_on_its_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == first_of_each(rows)[0]
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), folder).count() == 0


def test_sketches_keep_every_pair_that_is_near():
    """Sketches of sets of all sizes never rule out a similarity that is there, and rule out nearly all unlike ones."""
    rng = np.random.default_rng(3)
    sets, pairs = [], []
    for size in (1, 2, 9, 60, 250, 300, 900, 5_000):
        for share in (0.0, 0.5, 0.79, 0.8, 0.81, 0.9, 1.0):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            for other in (size, int(size * 0.8), int(size / 0.8)):
                same = a[: round(share * min(size, other))]
                b = np.concatenate([same, rng.integers(0, 1 << 63, max(other - len(same), 0)).astype(np.uint64)])
                pairs.append((len(sets), len(sets) + 1))
                sets += [np.unique(a), np.unique(b)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    made = near_copies.sketches(np.concatenate(sets), first)
    n = np.diff(first)
    a, b = np.array(pairs).T
    small, wide = (np.stack([near_copies.folded(x, len(names)) for x in made]) for names in (near_copies.SMALL, near_copies.WIDE))
    full = near_copies.may_be_near([made[i] for i in a], [made[i] for i in b], n[a], n[b], 0.8)
    some, more = (near_copies.near_by_sketch(x, n, a, b, 0.8) for x in (small, wide))
    shared = near_copies.shared_members([sets[i] for i in a], [sets[i] for i in b])
    assert shared.tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in pairs]
    near = shared >= 0.8 * (n[a] + n[b] - shared) - 1e-9
    assert near.sum() > 30 and full[near].all() and some[near].all() and more[near].all()
    unlike = (shared < 0.1 * n[a]) & (n[a] > 30)
    assert unlike.sum() > 10 and not full[unlike].any() and not more[unlike & (n[a] < 2_000)].any()


def test_pairs_of_a_large_bucket_come_in_steps(monkeypatch):
    monkeypatch.setattr(near_copies, "PAIRS", 50_000)
    rng = np.random.default_rng(1)
    n = 2_000
    wide = np.zeros((n, len(near_copies.WIDE)), np.int64)
    wide[:, :4] = rng.integers(-(1 << 63), 1 << 63, (n, 4))
    wide[7] = wide[1_003]
    size = np.sort(rng.integers(95, 105, n))
    columns = {"digest": np.arange(n), "n": size, "root": np.arange(n), **{c: wide[:, i] for i, c in enumerate(near_copies.WIDE)}}
    steps = list(near_copies.unlike_pairs(pa.table(columns), np.array([0, n]), 0.8))
    assert len(steps) > 30
    assert {(int(x), int(y)) for a, b in steps for x, y in zip(a, b, strict=True)} == {(7, 1_003)}


def test_boilerplate_is_no_copy(docs):
    """Texts of some out of few common sentences: most share shingles, and few are alike."""
    rng = random.Random(2)
    lines = [" ".join(f"l{i}w{j}" for j in range(12)) for i in range(40)]
    rows = [(i, " ".join(rng.sample(lines, 8))) for i in range(400)]
    want, _, _ = first_of_each(rows)
    got = drop_near_copies(docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == want


def test_null_and_repeated_ids(docs):
    same = "one two three four five six seven"
    rows = [(None, same), (3, same), (3, "other words stand in this one here"), (None, None), (3, None), (4, "")]
    got = drop_near_copies(docs(rows)).collect()
    assert sorted([(r["doc_id"], r["text"]) for r in got], key=str) == sorted(
        [(None, same), (3, "other words stand in this one here"), (None, None)], key=str
    )


def test_words_made_to_collide_are_unlike(docs):
    """Words of 1,024 letters that plain sums of powers can't tell apart."""
    signs = ["ab"[bin(i).count("1") % 2] for i in range(1024)]
    a, b = "".join(signs), "".join("ba"["ab".index(c)] for c in signs)
    rows = [(1, a), (2, b), (3, a), (4, f"{a} {b} x y z"), (5, f"{b} {a} x y z")]
    got = drop_near_copies(docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 4, 5]


def test_close_fingerprints_meet_at_anchors(spark, docs, monkeypatch):
    """The anchors give pairs of sets, and all that they connect; the rare shingles see only what is left."""
    rows = [r for r in changed_copies(9, 120) if len(shingles(r[1])) > 1]
    words = [f"long{i}" for i in range(600)]
    rows += [(1_000 + i, " ".join([*words[:i], "other", *words[i + 1 :]])) for i in range(0, 600, 60)]
    seen = []

    def anchored(classes, most, bucket_rows):
        found = near_copies_anchored(classes, most, bucket_rows)
        prints = {r["digest"]: r["fingerprint"] & (2**64 - 1) for r in classes.collect()}
        seen.append((prints, most, [(r["a"], r["b"]) for r in found.collect()]))
        return found

    near_copies_anchored = near_copies.anchored_pairs
    monkeypatch.setattr(near_copies, "anchored_pairs", anchored)
    got = drop_near_copies(docs(rows))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == first_of_each(rows)[0]
    prints, most, pairs = seen[0]
    close = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= most]
    number = {d: i for i, d in enumerate(sorted(prints))}
    want = plain.roots(len(number), [(number[b], number[a]) for a, b in close])
    assert len(close) > 10
    assert plain.roots(len(number), [(number[max(p)], number[min(p)]) for p in pairs]) == want


def test_fingerprints_are_majorities():
    texts = pa.array(["a b c d e f g h", None, "x", "a b c d e a b c d e a b c d e"])
    hashes, first = near_copies.shingle_sets(texts, 5)
    want = []
    for begin, end in zip(first[:-1], first[1:], strict=True):
        own = [int(h) for h in hashes[begin:end]]
        want.append(sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in own) > len(own)))
    assert near_copies.majorities(hashes, first).view(np.uint64).tolist() == want
    assert near_copies.majorities(hashes[:0], np.zeros(2, np.int64)).tolist() == [0]


def test_no_pair_of_a_length_is_left():
    """Sizes alone may rule out every pair of sketches of one length."""
    sketch, n = np.zeros((3, len(near_copies.WIDE)), np.int64), np.array([10, 300, 900])
    assert not near_copies.near_by_sketch(sketch, n, np.array([0, 1]), np.array([1, 2]), 0.8).any()
    none = np.zeros(0, np.int64)
    assert len(near_copies.near_by_sketch(sketch, n, none, none, 0.8)) == 0


def variants(n):
    """Texts with a similarity just below 0.8, each with other words in 8 places of the same 608 words, and one near the first."""
    rng = random.Random(3)
    words, texts, places = [f"v{i}" for i in range(608)], [], []
    while len(texts) < n:
        own = {5 * k + 2 for k in rng.sample(range(120), 8)}
        if all(len(own & other) < 3 for other in places):
            places.append(own)
            texts.append(" ".join(f"n{len(texts)}x{i}" if i in own else w for i, w in enumerate(words)))
    return [(i, t) for i, t in enumerate([*texts, texts[0] + " end"])]


def test_unlike_sets_are_not_written_as_pairs(docs, monkeypatch):
    """What is written grows with the sets and not with the pairs that sketches leave open."""
    rows = variants(100)
    seen = {}

    def counted(df, name):
        out = near_written(df, name)
        seen[name] = out.count()
        return out

    near_written = near_copies.written
    monkeypatch.setattr(near_copies, "written", counted)
    want, near, _ = first_of_each(rows)
    assert len(near) and len(want) > 90
    got = drop_near_copies(docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == want
    assert max(n for name, n in seen.items() if "pairs" in name or "groups" in name) <= 2 * len(rows)


@pytest.mark.parametrize("members, long_sets", [(4_000_000, 16_000), (900, 7)])
def test_groups_in_parts(docs, monkeypatch, members, long_sets):
    """Groups larger than a task are cut into parts, of which each two meet."""
    monkeypatch.setattr(near_copies, "GROUP_MEMBERS", members)
    monkeypatch.setattr(near_copies, "LONG_SETS", long_sets)
    monkeypatch.setattr(near_copies, "PAIRS", 500)
    # the ways before the groups find nothing
    monkeypatch.setattr(near_copies, "likely_near", lambda sketch, n, a, b, least: np.zeros(len(a), bool))
    rows = variants(90) + [(1_000 + i, t) for i, t in changed_copies(4, 80) if t]
    got = drop_near_copies(docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == first_of_each(rows)[0]


@pytest.mark.parametrize("pairs", [250_000, 40])
def test_links_of_a_group_connect_what_is_near(monkeypatch, pairs):
    monkeypatch.setattr(near_copies, "PAIRS", pairs)
    rng = np.random.default_rng(6)
    sets = []
    for size in (1, 3, 40, 700, 9_000):
        sets += [np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)) for _ in range(4)]
    for _ in range(60):
        own = sets[rng.integers(len(sets))]
        gone = rng.integers(0, len(own) // 8 + 1)
        sets.append(np.unique(np.concatenate([own[gone:], rng.integers(0, 1 << 63, gone).astype(np.uint64)])))
    sets.sort(key=len)
    n, first = np.array([len(x) for x in sets]), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    near = []
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(np.intersect1d(x, y))
            near += [(i, j)] * (10 * both >= 8 * (len(x) + len(y) - both))
    root = np.arange(len(sets)) // 2 * 2
    own = [(i, int(root[i])) for i in range(len(sets))]
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    one = np.zeros(len(sets), np.int64)
    sketch = near_copies.long_sketches(near_copies.sketches(np.concatenate(sets), first), n)
    for part in (one, np.arange(len(sets)) % 2):
        asked = [(i, j) for i, j in near if part is one or part[i] != part[j]]
        a, b = near_copies.near_links(sets, root, part, 0.8, none)
        found = list(zip(a.tolist(), b.tolist(), strict=True))
        assert len(found) > 5 and all((max(p), min(p)) in near for p in found)
        whole = plain.roots(len(sets), [*own, *found])
        assert all(whole[i] == whole[j] for i, j in asked)
        a, b = near_copies.sketch_links(sketch, n, root, part, 0.8)
        group = plain.roots(len(sets), list(zip(a.tolist(), b.tolist(), strict=True)))
        assert all(group[i] == group[j] for i, j in asked if root[i] != root[j])
        assert len(a) < len(sets)


def test_likely_pairs_are_allowed_pairs():
    """Large unlike sets, whose small sketches rule nothing out, are not taken for likely; copies with some changes are."""
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, 3_000).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate([x[30:], rng.integers(0, 1 << 63, 30).astype(np.uint64)])) for x in sets]
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    small = np.stack([near_copies.folded(x, len(near_copies.SMALL)) for x in near_copies.sketches(np.concatenate(sets), first)])
    n, a, b = np.diff(first), np.repeat(np.arange(40), 40), np.tile(np.arange(40, 80), 40)
    assert near_copies.near_by_sketch(small, n, a, b, 0.8).all()
    likely = near_copies.likely_near(small, n, a, b, 0.8)
    assert likely[a + 40 == b].all() and likely.sum() <= 42
