"""Token ids, their packing and their files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loadgrain.llm.huffman import BLOCK, Code, code_lengths, read_ids, write_ids
from loadgrain.llm.packing import pack_powers_of_two, piece_lengths, write_buckets
from loadgrain.llm.tokens import WordEncoder

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

PATH = public.path("word_bpe_49k.json")
ODD = ["a", "B", "it's", "I'LL", " ", "\n", "\t", "\r", "\x0b", "\x1c", " ", "É", "É", "Σ", "İ", "İ", ","]
ODD += [".", "--", "—,", "3", "١", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "a<|startoftext|>b", "́", "'s", "ß"]
ODD += ["日本", "🙂", "|", "x,́", ".̸", "\x00", "ª", "thereratble"]


@pytest.fixture(scope="module")
def definition():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def ids_of():
    whole = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


def odd_texts(seed, n):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return [*texts, None, "", " ", "word " * 3000, "x" * 5000]


def test_words_give_the_ids_of_whole_texts(definition, ids_of):
    words = WordEncoder(definition)
    texts = odd_texts(1, 3000)
    for at in range(0, len(texts), 101):
        part = texts[at : at + 101]
        ids, starts = words.encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [ids_of(t) for t in part]


def test_packing(docs, definition, ids_of, tmp_path):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(odd_texts(2, 60))] + [(5, "again"), (5, "again")]
    pieces = pack_powers_of_two(docs(rows), definition, end_id=2, longest=64)
    got = pieces.collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["length"] == 1 << r["bucket"] <= 64 and r["offset"] == 0 for r in got)
    found = sorted((r["doc_id"] or -1, r["doc_tokens"], r["start"], bytes(r["ids"])) for r in got)
    want = []
    for doc, text in rows:
        ids = np.array([*ids_of(text), 2], "<u4")
        at = 0
        for n in piece_lengths(np.array([len(ids)]), 64)[0]:
            want.append((doc or -1, len(ids), at, ids[at : at + n].tobytes()))
            at += n
        assert at == len(ids)
    assert found == sorted(want)
    write_buckets(pieces, str(tmp_path / "buckets"))
    assert {p.name for p in (tmp_path / "buckets").iterdir() if p.is_dir()} == {f"bucket={b}" for b in {r["bucket"] for r in got}}
    assert pack_powers_of_two(docs([]), definition, end_id=2).count() == 0
    with pytest.raises(ValueError):
        pack_powers_of_two(docs([]), definition, end_id=2, longest=48)


def test_pieces_are_binary():
    lengths, pieces = piece_lengths(np.array([1, 13, 4096, 8195]), 4096)
    assert lengths.tolist() == [1, 8, 4, 1, 4096, 4096, 4096, 2, 1] and pieces.tolist() == [1, 3, 1, 4]


def test_files(spark, docs, definition, ids_of, tmp_path):
    rows = [(i, t) for i, t in enumerate(odd_texts(3, 80))] + [(7, "same id"), (None, "no id")]
    random.Random(1).shuffle(rows)
    path = str(tmp_path / "ids")
    write_ids(docs(rows), path, definition, end_id=1)
    got = read_ids(spark, path).collect()
    want = sorted((-1 if d is None else d, np.array([*ids_of(t), 1], "<u4").tobytes()) for d, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], bytes(r["ids"])) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += len(r["ids"]) // 4
    ordered = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered)
    write_ids(docs([]), str(tmp_path / "none"), definition, end_id=1)
    assert read_ids(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n, longest", [(1, 5), (2, 5), (32, 5), (300, 9), (3000, 20)])
def test_codes(n, longest):
    rng = np.random.default_rng(n)
    counts = (1.5 ** rng.integers(0, 60, n)).astype(np.int64) + 1
    lengths = code_lengths(counts, longest)
    assert lengths.max() <= longest and (n == 1 or abs((0.5**lengths).sum() - 1) < 1e-9)
    used = np.sort(rng.choice(50_000, n, replace=False))
    code = Code(used, lengths)
    for size in (0, 1, BLOCK, BLOCK + 1, 10_001):
        ids = used[rng.integers(0, n, size)]
        bits, checkpoints = code.encode(ids)
        assert (code.decode(bits, size, checkpoints) == ids).all()
        if size > BLOCK:  # a block on its own, from its checkpoint
            k = len(checkpoints) - 1
            assert (code.decode(bits, size - k * BLOCK, checkpoints[k:]) == ids[k * BLOCK :]).all()


def test_lengths_are_the_best_under_the_limit():
    """Against all complete codes of small alphabets."""
    import itertools

    for counts in ([1, 1, 2, 3, 5, 8], [1, 1, 1, 1], [100, 1, 1, 1, 1], [5, 5, 5]):
        for longest in (3, 4):
            best = min(
                sum(c * x for c, x in zip(counts, ls, strict=True))
                for ls in itertools.product(range(1, longest + 1), repeat=len(counts))
                if sum(0.5**x for x in ls) <= 1
            )
            got = code_lengths(np.array(counts), longest)
            assert int((got * counts).sum()) == best
    with pytest.raises(ValueError):
        code_lengths(np.ones(9, np.int64), 3)


def test_checksum_of_packed_ids(spark, definition, ids_of):
    """The digest columns of the registered query."""
    from loadgrain.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op6_pack_powers_of_two"](spark, folder).collect():
        ids = np.array([*ids_of(texts[r["doc_id"]]), 2], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
