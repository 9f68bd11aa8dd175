from __future__ import annotations

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from checks import spark_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadgrain.llm.alignment import aligned, align_tokenizers, byte_alphabet, character_cuts, piece_cuts
from loadgrain.llm.tokens import read_tokenizer

TEXTS = [
    None,
    "",
    " ",
    "  two  blanks at both ends  ",
    "Hello world, don't stop.\n\n  New\tline \r\n end",
    "naïve façade — “quoted” … 日本語 テキスト　全角 한국어 кириллица",
    "👨‍👩‍👧 emoji 😀😀 é ﬁ № ​\xa0nbsp   \x85 \x1c x",
    "<|endoftext|> <s> </s> <unk> <0x41> <pad>",
    "▁ mark ▁x",
    "null\x00byte ﻿ bom \U0010fffe",
    "same text again",
    "same text again",
    "x" * 3000 + " " + "é" * 2000 + " " + "ab " * 4000,
]


@pytest.fixture(scope="module")
def tokenizers():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), f.read()


def plain(texts, definition, model):
    """Rows of each text, tokenized whole, with links from a comparison of all byte ranges side by side."""
    ours, theirs = Tokenizer.from_str(definition), sentencepiece.SentencePieceProcessor(model_proto=model)
    ours.encode_special_tokens = True
    alphabet = byte_alphabet()
    found, counts = [], Counter()
    for text in texts:
        a = ours.encode(" " + (text or ""), add_special_tokens=False)
        b = theirs.encode(text or "")
        bytes_a = [bytes(alphabet[c] for c in t) for t in a.tokens]
        names = [theirs.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if theirs.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names, strict=True)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(None)
            continue
        spans = []
        for ids, parts in ((a.ids, bytes_a), (b, bytes_b)):
            ends = [sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 500 else _sums(parts)
            spans.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends, strict=True)])
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, begin = [], 0
        for end in common:
            inside = [",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in spans] if len(common) < 500 else None
            groups.append(inside and "|".join(inside))
            begin = end
        links, at = [], 0
        for i, s, e in spans[0]:
            while spans[1][at][2] <= s:
                at += 1
            k = at
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        counts.update(links)
        found.append((len(spans[0]), len(spans[1]), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return found, counts, best


def _sums(parts):
    out, total = [], 0
    for p in parts:
        total += len(p)
        out.append(total)
    return out


def test_against_whole_texts(spark, docs, tokenizers):
    table = docs(list(enumerate(TEXTS)))
    found, counts, best = plain(TEXTS, *tokenizers)
    rows = {r["doc_id"]: r for r in aligned(table, *tokenizers).collect()}
    sums = {r["doc_id"]: r for r in align_tokenizers(table, *tokenizers).collect()}
    assert [f is None for f in found] == [i in (0, 1, 8) for i in range(len(TEXTS))]
    for i, f in enumerate(found):
        row, total = rows[i], sums[i]
        if f is None:
            assert (row["groups"], row["pairs"], total["groups_sha256"]) == ("", [], "")
            assert [total[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] == [0] * 6
            continue
        n_a, n_b, groups, links = f
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (n_a, n_b, len(groups), len(links))
        if groups[0] is not None:
            assert row["groups"] == ";".join(groups)
        assert dict(zip(row["pairs"], row["times"], strict=True)) == Counter(a << 32 | b for a, b in links)
        assert total["n_best"] == sum(counts[x] == best[x[1]] for x in links)
        assert total["count_sum"] == sum(counts[x] for x in links)


def test_joined_counts_equal_looked_up(spark, docs, tokenizers):
    table = docs([(i % 7, t) for i, t in enumerate(TEXTS * 5)] + [(None, "no id here")] * 3)
    looked_up = spark_rows(align_tokenizers(table, *tokenizers))
    assert len(looked_up) == len(TEXTS) * 5 + 3
    assert spark_rows(align_tokenizers(table, *tokenizers, max_pairs=0, pair_rows=20)) == looked_up


def test_digest_of_groups(spark, docs, tokenizers):
    table = docs([(1, "a few words")])
    groups = aligned(table, *tokenizers).select(F.sha2("groups", 256).alias("d")).first()["d"]
    assert align_tokenizers(table, *tokenizers).first()["groups_sha256"] == groups


def test_no_rows(docs, tokenizers):
    assert align_tokenizers(docs([]), *tokenizers).collect() == []


def test_cuts():
    # tokens of 2, 2, 1 and 2 bytes over "aé日b": the middle ones share characters
    spans = np.array([(0, 2), (1, 3), (2, 3), (2, 4)])
    assert character_cuts(spans, np.array([2, 2, 1, 2]), np.array([0, 1, 3, 6, 7])).tolist() == [2, 4, 5, 7]
    spans = np.array([(0, 0), (0, 0), (0, 3), (3, 4)])
    assert piece_cuts(spans, np.array([1, 1, 2, 1]), 1).tolist() == [1, 2, 4, 5]
