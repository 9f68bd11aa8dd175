"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.llm.common import small_batches, steps

NOTHING = "und"
# n-grams of 1 to LONGEST characters, hashed to 2**BITS features
LONGEST = 3
BITS = 15
# documents of each language that the weights are fitted on; counts and n-gram statistics use all documents
SAMPLE = 1500
# shares of the sample for the weights and for the temperature
CALIBRATION = 5


@dataclass
class LanguageModel:
    """``weights`` of features and languages, ``bias``, ``idf`` of features, and the ``temperature``."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def logits(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = tf_idf(features, counts, self.idf)
        return x @ self.weights[features] + self.bias


@cache
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def tf_idf(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[features]
    return x / np.sqrt(x @ x)


def ngrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its features and how often each occurs; none for a text without letters.

    Texts are lower-cased; what is no letter counts as one blank.
    """
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, lowered), np.int64, len(lowered))
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of other characters stands for all of them
    ends = np.cumsum(size + 1) - 1
    kept = np.concatenate([[0], np.cumsum(keep)])
    begin = kept[ends - size]
    end = kept[ends]
    code = np.where(letter, points, 32)[keep].astype(np.uint64)
    some = np.concatenate([[0], np.cumsum(letter)])
    lettered = some[ends] > some[ends - size]
    grams = []
    value = code * np.uint64(0x9E3779B97F4A7C15)
    for n in range(LONGEST):
        if n:
            value = value[:-1] * np.uint64(0x100000001B3) + code[n:] * np.uint64(0x9E3779B97F4A7C15)
        grams.append(((value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64))
    for i in range(len(lowered)):
        if not lettered[i]:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        own = np.concatenate([g[begin[i] : max(end[i] - n, begin[i])] for n, g in enumerate(grams)])
        if len(own) < 1000:
            yield np.unique(own, return_counts=True)
        else:
            counts = np.bincount(own, minlength=1 << BITS)
            found = np.flatnonzero(counts)
            yield found, counts[found]


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and the number of documents; added up within tasks first."""

    def count(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in steps(batches):
            for features, _ in ngrams(batch.column(0).to_pylist()):
                total[features] += 1
                n += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["feature", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # 2**BITS + 1 rows at most
    total = np.zeros((1 << BITS) + 1, np.int64)
    total[found["feature"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return total[:-1], int(total[-1])


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    n_classes: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
    epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader with per-coordinate rates: ``rows`` are features, values and the class.

    ``l1`` keeps weights at zero, ``l2`` keeps them small. The bias is the last coordinate, unpenalised by ``l1``.
    """
    size = (1 << BITS) + 1
    z, n = np.zeros((size, n_classes)), np.zeros((size, n_classes))

    def weights(at, l1):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for features, values, label in rows:
            at = np.append(features, size - 1)
            x = np.append(values, 1.0)
            w = weights(at, l1)
            w[-1] = weights(at[-1:], 0.0)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    return weights(np.arange(size - 1), l1), weights(np.array([size - 1]), 0.0)[0]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes held-back labels likeliest, by narrowing a range of logarithms.

    As in Platt scaling, a label counts as right with (n + 1) / (n + 2) only, so that rows without a single
    error don't make every later prediction certain.
    """
    doubt = 1 / (len(labels) + 2)
    target = np.full(logits.shape, doubt / max(logits.shape[1] - 1, 1))
    target[np.arange(len(labels)), labels] = 1 - doubt

    def loss(t):
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(axis=1).mean()

    low, high = np.log(0.02), np.log(20.0)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train_language_model(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Train on the rows of ``docs`` (``doc_id``, ``text``, ``lang``) with a text and a language.

    Inverse document frequencies come from all of these rows. The weights are fitted on about ``sample``
    documents of each language, chosen by a hash of ``doc_id``, so the driver's share is bounded; every
    fifth of those is kept back for the temperature. Without any labelled text the model knows no language.
    """
    docs = small_batches(docs).filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = docs.groupBy("lang").count().orderBy("lang").toPandas()  # a row for each language
    languages = counts["lang"].tolist()
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0)), np.zeros(0), np.ones(1 << BITS), 1.0)
    frequency, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + frequency)) + 1

    share = F.lit(0.0)
    for lang, count in zip(languages, counts["count"], strict=True):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / count))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_003))
    chosen = docs.withColumn("place", place).filter(F.col("place") < share * 1_000_003)
    chosen = chosen.limit(2 * sample * len(languages))

    def features(batches):
        for batch in steps(batches):
            found = list(ngrams(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                    pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32())),
                    batch.column(2),
                ],
                names=["place", "features", "counts", "lang"],
            )

    rows = chosen.select("place", "text", "lang").mapInArrow(
        features, "place long, features array<int>, counts array<int>, lang string"
    )
    rows = rows.filter(F.size("features") > 0).toArrow()
    which = {lang: i for i, lang in enumerate(languages)}
    lists = [rows.column(c).combine_chunks() for c in ("features", "counts")]
    data = []
    for i, (place, lang) in enumerate(zip(rows.column("place").to_pylist(), rows.column("lang").to_pylist(), strict=True)):
        own, count = (np.asarray(x[i].values) for x in lists)
        data.append((place, len(own), own, tf_idf(own, count, idf), which[lang]))
    data.sort(key=lambda r: (r[0], r[1], r[4], r[3][:3].tolist()))
    kept_back = data[:: CALIBRATION] if len(data) >= 50 else data
    fitted = [r for i, r in enumerate(data) if i % CALIBRATION] if len(data) >= 50 else data
    if not data:
        return LanguageModel(languages, np.zeros((1 << BITS, len(languages))), np.zeros(len(languages)), idf, 1.0)
    weights, bias = fit_ftrl([r[2:] for r in fitted], len(languages))
    model = LanguageModel(languages, weights, bias, idf, 1.0)
    logits = np.array([x @ weights[f] + bias for _, _, f, x, _ in kept_back])
    model.temperature = fit_temperature(logits, np.array([r[4] for r in kept_back]))
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns of ``docs``.

    ``lang_pred`` is the likeliest language of the whole text and ``score`` its calibrated probability. A text
    that is null or has no letter gets ``und`` with score 0, and so does every text if the model knows no
    language. Only the text is looked at. One pass without a shuffle; an empty table gives no rows. Columns named
    ``lang_pred`` or ``score`` in ``docs`` are replaced.
    """
    docs = small_batches(docs).drop("lang_pred", "score")

    def predict(batches):
        m = shared.value
        for batch in steps(batches):
            text = batch.column(batch.schema.get_field_index("text"))
            names, scores = [], []
            for features, counts in ngrams(text.to_pylist()):
                if not len(features) or not m.languages:
                    names.append(NOTHING)
                    scores.append(0.0)
                    continue
                p = softmax(m.logits(features, counts) / m.temperature)
                best = int(p.argmax())
                names.append(m.languages[best])
                scores.append(float(p[best]))
            yield batch.append_column("lang_pred", pa.array(names, pa.string())).append_column("score", pa.array(scores))

    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType(list(docs.schema.fields)).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(predict, out)
