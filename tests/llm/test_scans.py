"""Secrets and personal data against plain regular expressions."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadgrain.llm.pii import (
    LABELS,
    Tagger,
    base_spans,
    find_personal_data,
    labelled_rows,
    luhn,
    mask,
    mask_personal_data,
    possible,
    sequence_features,
    shape,
    train_crf,
    viterbi,
)
from loadgrain.llm.secret_scan import ALLOWED, as_text, find_secrets, highest_entropy

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
TOKEN = "Zx9+Qw3/Lk7_Pt5=Vb1-Nm8"


def secret_spans(t: str):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16])


def entropy(s: str, window: int = 20) -> float:
    parts = (collections.Counter(s[i : i + window]).values() for i in range(len(s) - window + 1))
    return max(-sum(c / window * math.log2(c / window) for c in p) for p in parts)


def more_secrets(t: str):
    base = secret_spans(t)
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t):
        if any(re.search(p, m[0]) for p in ALLOWED) or any(a < m.end() and m.start() < b for a, _, b, _ in base):
            continue
        if re.fullmatch("[0-9A-Fa-f]+", m[0]):
            if entropy(m[0]) >= 3:
                yield m.start(), 3, m.end(), "entropy_hex"
        elif entropy(m[0]) >= 4:
            yield m.start(), 4, m.end(), "entropy_base64"


def texts_from(parts, seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_secrets(docs):
    parts = ["token", "SECRET", "api_key", "apikey", "PassWord", "=", ":", " ", "  ", '"', "'", "é", "\n", "AKIA", "ABC123", "🙂"]
    parts += ["0123456789abcdef", "abc", "deadbeef", TOKEN, TOKEN[::-1], "0F1E2D3C4B5A69788796A5B4", "a.b", "word", "x" * 30]
    parts += ["123e4567-e89b-12d3-a456-426614174000", "2024-01-02-03-04-05-06-07", "1" * 25, "exampleA1b2C3d4E5f6G7h8I9"]
    texts = texts_from(parts, 4, 400, 12) + ["", None, "token=secret=abcdefghijklmnop : zzzzzzzzzzzzzzz", "y " * 4000 + TOKEN]
    rows = [(i // 2, t) for i, t in enumerate(texts)] + [(None, "password: hunter2hunter2")]
    found = find_secrets(docs(rows)).select("doc_id", as_text(F.col("base")), as_text(F.col("added")))
    got = sorted((r[0] or -1, r[1], r[2]) for r in found.collect())
    text = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    want = sorted((d or -1, text(secret_spans(t or "")), text(more_secrets(t or ""))) for d, t in rows)
    assert got == want
    assert sum(1 for r in got if "entropy_base64" in r[2]) > 5 and any("entropy_hex" in r[2] for r in got)
    assert find_secrets(docs([])).count() == 0


def test_entropy_moves_with_the_window(spark):
    rng = random.Random(1)
    strings = ["".join(rng.choice("abc123XYZ+/") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for r in df.select("s", highest_entropy(F.col("s"), "abc123XYZ+/").alias("h")).collect():
        assert r["h"] is None if len(r["s"]) < 20 else r["h"] == pytest.approx(entropy(r["s"]))


def test_secrets_use_no_python(spark, docs):
    plan = find_secrets(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def personal(t: str):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_personal_data():
    parts = list("ab.@-_%+0123456789 (é\n") + ["4111 1111 1111 1111", "+1 555 123 4567", "10.0.0.255", "x@y.zz", "5500-0000-0000-0004"]
    for t in texts_from(parts, 5, 20_000, 30) + ["a" * 20_000, "1" * 20_000, "1." * 5_000, "a@" * 5_000, "+1" * 5_000]:
        assert base_spans(t) == personal(t)


def test_luhn_and_shape():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert (shape("McDonald"), shape("555-0199"), shape("Éa")) == ("XxXxxx", "ddd-ddd", "Xx")


@pytest.fixture(scope="module")
def model():
    return train_crf(labelled_rows())


def test_the_field_learns_its_table_and_more(model):
    tagger = Tagger(model)
    rows = labelled_rows()
    right = total = 0
    for words, labels in rows:
        text = " ".join(words)
        marked = {(a, b) for a, _, b in tagger.spans([text])[0]}
        at, spans, open_ = 0, set(), None
        for w, label in zip([*words, ""], [*labels, 0], strict=True):
            if open_ and not LABELS[label].startswith("I"):
                spans.add((open_, at - 1))
                open_ = None
            if LABELS[label].startswith("B"):
                open_ = at or 1e-9
            at += len(w) + 1
        spans = {(int(a), b) for a, b in spans}
        right += len(spans & marked)
        total += len(spans | marked)
    assert right >= 0.9 * total
    got = tagger.spans(["My name is Robert Miller, phone 555-123-4567.", "", "The river was cold. Then it rose."])
    assert [[("My name is Robert Miller, phone 555-123-4567."[a:b]) for a, _, b in s] for s in got] == [["Robert Miller", "555-123-4567"], [], []]


def test_chains_give_the_best_labels_of_whole_texts(model):
    """Decoding chains of possible words equals decoding all words of a text at once."""
    rng = random.Random(2)
    vocabulary = "Anna Mr . name is the river 555-1234 ( 212 ) phone call Keller and 12 + / Dear , Peter".split()
    tagger = Tagger(model)
    for _ in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 25))]
        zero = np.zeros(len(LABELS))
        scores = np.array(
            [
                sum((model.own.get(f, model.sides.get(f, zero)) for f in fs), zero)
                + np.where(np.arange(len(LABELS)) == 0, 0.0, 0.0 if possible(w) else -1000.0)
                for w, fs in zip(words, sequence_features(words), strict=True)
            ]
        )
        best = viterbi(scores[:, None], np.array([len(words)]), model.move)[:, 0]
        kinds = [LABELS[i] for i in best]
        want, at = [], 0
        for w, k in zip(words, kinds, strict=True):
            if k[0] == "B":
                want.append([at, at + len(w)])
            elif k[0] == "I":
                want[-1][1] = at + len(w)
            at += len(w) + 1
        assert [[a, b] for a, _, b in tagger.spans([" ".join(words)])[0]] == want


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    scores, move = rng.standard_normal((5, 3, 4)), rng.standard_normal((4, 4))
    lengths = np.array([1, 3, 5])
    got = viterbi(scores, lengths, move)
    for k, n in enumerate(lengths):
        def value(path, k=k):
            return sum(scores[t, k, p] + move[path[t - 1] if t else 0, p] for t, p in enumerate(path))

        assert tuple(got[:n, k]) == max(itertools.product(range(4), repeat=int(n)), key=value)


def test_documents(docs):
    rows = [(1, "Mail anna@example.org or +1 (212) 555-0147."), (1, "Mail anna@example.org or +1 (212) 555-0147."), (None, None)]
    rows += [(2, ""), (3, "My name is Anna Keller 🙂 from 10.0.0.1"), (4, "a " * 20_000)]
    df = docs(rows)
    found = find_personal_data(df)
    assert found.columns == [*df.columns, "base", "added"]
    got = {r["doc_id"]: r for r in found.collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[1]["base"]] == [("email", 5, 21), ("phone", 25, 42)]
    assert [s["kind"] for s in got[3]["added"]] == ["name"] and got[None]["base"] == [] and got[4]["added"] == []
    masked = mask_personal_data(df)
    assert masked.columns == df.columns and masked.schema == df.schema
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[1] == "Mail [email] or [phone]." and texts[None] is None and texts[2] == ""
    assert texts[3] == "My name is [name] 🙂 from [ip]"
    assert find_personal_data(docs([])).count() == 0
    assert mask("abcdef", [(1, 0, 3, "x"), (2, 1, 5, "y")]) == "a[x]def"
