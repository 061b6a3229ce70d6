"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are lower-cased character n-grams of one to three characters, hashed to ``DIMS``
columns, weighted TF-IDF and scaled to unit length. Document frequencies are counted over
all documents to learn from. The weights are trained with follow-the-regularised-leader
(FTRL-proximal, elastic net) on a sample bounded by ``MAX_TRAINING``, spread evenly over the
languages; a fifth of it is set aside to calibrate the temperature of the softmax.

Defined cases: null text, and text without a letter, is ``und`` with score 0; so is every
text when there is nothing to learn from; rows without a language teach nothing; repeated
rows are each returned; further columns of the input do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, documents, hand_back, held_out, texts_of
from .ngrams import groups_of, ngram_counts, share

ORDERS = (1, 2, 3)
DIMS = 1 << 14
MAX_TRAINING = 3_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.05
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMS x languages, sparse in the sense of many zeros
    bias: np.ndarray
    temperature: float = 1.0

    def vectors(self, texts: list[str]) -> np.ndarray:
        x = ngram_counts([t.lower() for t in texts], ORDERS, len(self.idf)) * self.idf
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(norm > 0, norm, 1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        p = softmax(self.logits(self.vectors(texts)) / self.temperature)
        letters = np.array([bool(LETTER.search(t)) for t in texts])
        best = p.argmax(axis=1)
        return ([self.languages[b] if ok else "und" for b, ok in zip(best, letters)],
                np.where(letters, p.max(axis=1), 0.0))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, dims: int,
         epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a softmax regression on sparse rows (columns, values)."""
    z, n = np.zeros((dims + 1, classes)), np.zeros((dims + 1, classes))
    penalty = np.full((dims + 1, 1), L1)
    penalty[dims] = 0  # the bias is not thinned out

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * penalty[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= penalty[at], 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at = np.append(rows[i][0], dims)
            value = np.append(rows[i][1], 1.0)[:, None]
            w = weights(at)
            error = softmax((value * w).sum(axis=0)[None, :])[0]
            error[labels[i]] -= 1
            g = value * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(dims + 1))
    return w[:dims].astype(np.float32), w[dims].astype(np.float32)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden section on its logarithm."""
    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()
    a, b, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(docs: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, int]:
    """How many texts have each hashed n-gram, and how many texts there are."""
    def run(batches):
        df, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = [t.lower() for t in texts_of(part, "text")]
                for a, b in groups_of(len(texts)):
                    df += (ngram_counts(texts[a:b], ORDERS, dims) > 0).sum(axis=0)
                n += len(texts)
            hand_back()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims)), pa.array(np.append(n, df))], ["feature", "n"])

    rows = (docs.select("text").mapInArrow(run, "feature bigint, n bigint")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())  # DIMS + 1 rows at most
    out = np.zeros(dims + 1, np.int64)
    for r in rows:
        out[r.feature + 1] = r.n
    return out[1:], int(out[0])


def train(docs: DataFrame, max_training: int = MAX_TRAINING) -> LanguageModel | None:
    """A model of the rows of ``docs`` (doc_id, text, lang) that have text and language."""
    docs = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().orderBy("lang").collect()}
    if not counts:
        return None
    each = max(1, max_training // len(counts))
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, min(1.0, each / v))]), F.col("lang"))
    sample = docs.filter(share(rate, "doc_id", "text")).select("text", "lang").collect()  # about max_training rows
    sample = sorted(map(tuple, sample), key=lambda r: (r[1], r[0]))
    df, n = document_frequencies(docs)
    model = LanguageModel(list(counts), (np.log((1 + n) / (1 + df)) + 1).astype(np.float32),
                          np.zeros((DIMS, len(counts)), np.float32), np.zeros(len(counts), np.float32))
    rows = []
    for a, b in groups_of(len(sample)):
        for x in model.vectors([t for t, _ in sample[a:b]]):
            at = np.flatnonzero(x)
            rows.append((at.astype(np.int32), x[at]))
    labels = np.array([model.languages.index(lang) for _, lang in sample])
    aside = np.arange(len(rows)) % 5 == 4
    fit = np.flatnonzero(~aside)
    model.weights, model.bias = ftrl([rows[i] for i in fit], labels[fit], len(counts), DIMS)
    if aside.any():
        logits = np.array([rows[i][1] @ model.weights[rows[i][0]] + model.bias for i in np.flatnonzero(aside)])
        model.temperature = temperature(logits, labels[aside])
    return model


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with lang_pred and score (an input column of these names is replaced)."""
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                for a, b in groups_of(part.num_rows):
                    some = part.slice(a, b - a)
                    langs, scores = model.predict(texts_of(some, "text"))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(langs), pa.array(scores.astype(float))],
                                                     [*some.schema.names, "lang_pred", "score"])
            hand_back()

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(run, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.filter(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op7_language_id": op7_language_id}
