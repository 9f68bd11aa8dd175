"""Language identification, decontamination, and the pipeline."""

from __future__ import annotations

import importlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_near_copies import first_of_each

from loadgrain.llm import templates
from loadgrain.llm.langid import NOTHING, LanguageModel, fit_ftrl, fit_temperature, identify, ngrams, train_language_model
from loadgrain.llm.queries import QUERIES, held_out
from loadgrain.llm.templates import decontaminate, find_leaks, word_template

SMALL = "/root/testdata/sf0.001"


def test_ngrams():
    def plain_grams(text):
        low = re.sub("[^a-zß]+", " ", text.lower()) if re.search("[a-zA-Z]", text) else ""
        return sum(max(len(low.lstrip(" ")) - n, 0) for n in range(3))

    for text in ("Hello, World!", "abc", "a", "12 ab", "x" * 3000, "..a..b.."):
        features, counts = next(ngrams([text]))
        assert counts.sum() == plain_grams(text) and len(set(features.tolist())) == len(features)
    assert [len(f) for f, _ in ngrams([None, "", "123 !", "ab"])] == [0, 0, 0, 3]
    alone = [next(ngrams([t])) for t in ("first text", "second", "third one")]
    together = list(ngrams(["first text", "second", "third one"]))
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(alone, together, strict=True))


def test_ftrl_is_sparse_and_right():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        label = int(rng.integers(0, 3))
        features = np.unique(np.concatenate([[label], 10 + rng.integers(0, 500, 6)]))
        rows.append((features, np.full(len(features), 0.4), label))
    weights, bias = fit_ftrl(rows, 3, l1=0.5)
    assert all((x @ weights[f] + bias).argmax() == y for f, x, y in rows)
    assert (weights[10:510] == 0).mean() > 0.5 and (weights[600:] == 0).all()


def test_temperature():
    rng = np.random.default_rng(2)
    logits = rng.standard_normal((3000, 3)) * 3
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=row) for row in p])
    assert fit_temperature(logits, labels) == pytest.approx(1, abs=0.15)
    assert fit_temperature(logits * 5, labels) == pytest.approx(5, abs=0.75)
    assert fit_temperature(np.array([[9.0, 0.0]] * 20), np.zeros(20, int)) > 1


def test_held_out_accuracy(spark):
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_labels_of_held_out_rows_are_never_used(spark, docs):
    rows = [(i, random.Random(i).choice(["der die das und ist", "the and of is to"]) + f" w{i}") for i in range(200)]
    rows = [(i, t, "de" if "der" in t else "en") for i, t in rows]
    out = {r[0] for r in docs(rows).filter(held_out()).select("doc_id").collect()}
    lies = [(i, t, "xx" if i in out else lang) for i, t, lang in rows]
    models = [train_language_model(docs(r).filter(~held_out())) for r in (rows, lies)]
    assert models[0].languages == models[1].languages == ["de", "en"]
    assert (models[0].weights == models[1].weights).all() and models[0].temperature == models[1].temperature
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs(rows), models[0]).collect()}
    assert all(found[i] == lang for i, _, lang in rows)


def test_language_edges(docs):
    rows = [(1, None), (None, "12 !"), (2, ""), (3, "the cat and the dog " * 5000), (3, "the cat")]
    model = train_language_model(docs([(i, "the cat and the dog", "en") for i in range(60)] + [(99, "x", None)]))
    found = identify(docs(rows), model)
    got = sorted((r["doc_id"] or 0, r["lang_pred"], round(r["score"], 6)) for r in found.collect())
    assert got == [(0, NOTHING, 0), (1, NOTHING, 0), (2, NOTHING, 0), (3, "en", 1), (3, "en", 1)]
    nothing = train_language_model(docs([]))
    assert isinstance(nothing, LanguageModel) and nothing.languages == []
    assert {r["lang_pred"] for r in identify(docs(rows), nothing).collect()} == {NOTHING}
    assert identify(docs([]), model).count() == 0


TRAIN = "If a train travels {} km in {} hours, how far does the train of {} travel in {} hours at {} km?"


def test_templates():
    assert word_template("120,")[:2] == ("120", templates.SLOT_NUMBER)
    assert word_template("3kg")[1] == templates.SLOT_NUMBER and word_template("km.")[1] == templates.SLOT_UNIT
    assert word_template("(Anna)")[:3] == ("anna", templates.LITERAL, True) and word_template("—")[1] == templates.NOTHING
    assert word_template("end.")[3] and not word_template("end,")[3]


@pytest.mark.parametrize("look_up", [1_000_000, 0])
def test_reparameterised_items(spark, docs, look_up):
    items = [(1, TRAIN.format(120, 3, "Anna", 7, 120)), (2, "Short one"), (3, None), (4, ""), (None, "12 34 56 78 90 12 34 56 78")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "Well. " + TRAIN.format(120, 3, "Anna", 7, 120).upper().lower() + " Yes."),
        (2, "Hello there. " + TRAIN.format(90, 5, "Peter", 9, 90)),
        (3, TRAIN.format(90, 5, "Peter", 9, 80)),  # 120 becomes both 90 and 80
        (4, TRAIN.format(90, 9, "Peter", 9, 90)),  # 3 and 7 both become 9
        (5, "the train of Anna is late, and how far it travels in 3 hours is not known to us"),
        (6, None), (7, ""), (None, TRAIN.format(120, 3, "Anna", 7, 120)), (2, "Hello there. " + TRAIN.format(90, 5, "Peter", 9, 90)),
    ]
    leaks = find_leaks(docs(rows), benchmark, look_up=look_up)
    got = sorted((r["doc_id"] or 0, r["item_id"], r["same_values"]) for r in leaks.collect())
    assert got == [(0, 1, True), (2, 1, False)] or got == [(0, 1, True), (1, 1, True), (2, 1, False)]
    found = decontaminate(docs(rows), benchmark)
    assert found.columns == [*(c for c in docs([]).columns if c != "items"), "contaminated", "items"]
    flags = sorted((r["doc_id"] or 0, r["contaminated"], tuple(r["items"])) for r in found.collect())
    assert len(flags) == len(rows) and (2, True, (1,)) in flags and flags.count((2, True, (1,))) == 2
    assert {f[0] for f in flags if f[1]} <= {0, 1, 2}
    assert decontaminate(docs([]), benchmark).count() == 0
    assert not any(r["contaminated"] for r in decontaminate(docs(rows), benchmark.limit(0)).collect())


def test_leaks_of_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    words = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc, text in texts:
        own = sorted(i for i, t in items if t in words(text))
        if own:
            want[doc] = own
    found = QUERIES["op1_template_leaks"](spark, folder).filter("contaminated").collect()
    assert {r["doc_id"]: list(r["items"]) for r in found} == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SMALL), "test")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    assert list(seen) == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    before, after = (sorted(x.select("doc_id", "text").collect()) for x in seen["near_duplicates"])
    assert [tuple(r) for r in after] == [tuple(r) for r in first_of_each(before)[0]]
    before, after = seen["decontamination"]
    found = decontaminate(before, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert after.count() == found.filter("not contaminated").count() < before.count()
    before, after = seen["personal_data"]
    assert after.count() == before.count() and after.filter("n_chars <> length(text)").count() == 0
    assert after.filter(F.col("text").rlike("[a-z0-9]@[a-z]+[.]")).count() == 0
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.count()
    assert after.groupBy("doc_id").agg((F.sum("length") - F.max("doc_tokens")).alias("d")).filter("d <> 0").count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() == after.count()


def test_pipeline_edges(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "the cat and the dog", "en", "s", 1), (2, "the cat and the dog", "en", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, table)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        # five tokens and the end, as pieces of four and two, of one of the two rows that are alike
        assert sorted((r["doc_id"], r["length"]) for r in docs.collect()) == ([(2, 2), (2, 4)] if data else [])


def test_entry_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    for name in [n for n in sys.modules if n.startswith("loadgrain.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "loadgrain.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline")
    fresh = importlib.reload(__spark_entry__)
    assert not set(QUERIES) & set(fresh.queries()) and "load_signatures" in fresh.queries()
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
