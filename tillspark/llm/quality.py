"""Quality classifier by positive-unlabelled learning (non-negative unbiased risk).

Trusted positives are the rows labelled good; the unlabelled set is all web text to learn
from, labels ignored. With the class prior p, the risk of a classifier f is

    p E_P[loss(f, +)] + max(0, E_U[loss(f, -)] - p E_P[loss(f, -)])

where the second part, an estimate of the risk on bad text, cannot be negative; where a
batch makes it so, its gradient is taken with the other sign, which stops the model from
learning the positives by heart. The loss is logistic, so the sigmoid of f estimates the
probability of a good text. The prior is the share of good among the labelled rows, which
are a sample of the web text; the labels themselves teach positives alone.

Features: the square roots of the relative counts of hashed character n-grams (one to
three characters, as written), and shares of upper case, digits, marks, blanks, different
words, words equal to the one before, repeated word pairs and repeated lines. Positives and unlabelled rows are each a sample bounded by
``MAX_POSITIVE`` and ``MAX_UNLABELLED``.

Defined cases: null counts as empty text; an empty text has a score like any other; a
doc_id with several labels is a positive if any label is 1; without positives every score
is 0; repeated rows are each returned; further columns of the inputs do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, documents, held_out, resident, texts_of
from .ngrams import groups_of, ngram_counts, share

ORDERS = (1, 2, 3)
DIMS = 1 << 12
MAX_POSITIVE, MAX_UNLABELLED = 2_500, 5_000
EPOCHS, BATCHES = 40, 20
RATE, DECAY = 0.01, 1e-4
GOOD = 0.7
GRAM_SCALE = 0.2
CLASSES = 5  # other, upper case, number, mark, blank
SHAPES = CLASSES - 1 + 4 + 1


def character_classes() -> np.ndarray:
    """Class of each code point: 1 upper case, 2 number, 3 neither letter nor number, 4 blank."""
    chars = map(chr, range(0x110000))
    return np.fromiter((4 if c.isspace() else 1 if c.isupper() else 2 if c.isnumeric() else 0 if c.isalpha() else 3
                        for c in chars), np.uint8, 0x110000)


def vectors(texts: list[str]) -> np.ndarray:
    """Feature rows: n-gram part of unit length, then the shapes, then a one."""
    grams = ngram_counts(texts, ORDERS, DIMS)
    grams = np.sqrt(grams / np.maximum(grams.sum(axis=1, keepdims=True), 1))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)) * CLASSES, sizes)
    table = resident("character classes", character_classes)
    classes = np.bincount(owner + table[codes], minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES)
    shares = classes[:, 1:] / np.maximum(sizes, 1)[:, None]
    return np.hstack([grams, shares, [repetition(t) for t in texts], np.ones((len(texts), 1))]).astype(np.float32)


def repetition(text: str) -> list[float]:
    """Shares of different words, words like the one before, repeated pairs, repeated lines."""
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    n = max(1, len(words) - 1)
    return [len(set(words)) / max(1, len(words)),
            sum(map(eq, words, words[1:])) / n,
            1 - len(set(zip(words, words[1:]))) / n if len(words) > 1 else 0.0,
            1 - len(set(lines)) / max(1, len(lines))]


@dataclass
class QualityModel:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(((vectors(texts) - self.mean) / self.scale) @ self.weights)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 11) -> np.ndarray:
    """Weights of a linear model by Adam on the non-negative risk.

    The steps grow shorter, and the weights of the second half of the epochs are averaged:
    turned gradients make single steps unsteady.
    """
    rng = np.random.default_rng(seed)
    w = np.zeros(positive.shape[1])
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    mean, averaged = np.zeros_like(w), 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        parts = zip(np.array_split(rng.permutation(len(positive)), BATCHES),
                    np.array_split(rng.permutation(len(unlabelled)), BATCHES))
        for p, u in parts:
            if not len(p) or not len(u):
                continue
            xp, xu = positive[p], unlabelled[u]
            fp, fu = xp @ w, xu @ w
            bad = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            good_step = -prior * (xp * sigmoid(-fp)[:, None]).mean(axis=0)
            bad_step = (xu * sigmoid(fu)[:, None]).mean(axis=0) - prior * (xp * sigmoid(fp)[:, None]).mean(axis=0)
            step = (good_step + bad_step if bad >= 0 else -bad_step) + DECAY * w
            t += 1
            m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
            w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            if 2 * epoch >= EPOCHS:
                averaged += 1
                mean += (w - mean) / averaged
    return mean if averaged else w


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> QualityModel | None:
    """A model of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) to learn from."""
    labels = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = labels.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("quality") == 1).cast("bigint")).alias("good")).first()
    if not marked.good:
        return None
    prior = min(prior if prior is not None else marked.good / marked.n, 0.999)
    chosen = labels.filter((F.col("quality") == 1) & share(F.lit(min(1.0, MAX_POSITIVE / marked.good)), "doc_id"))
    positive = _texts(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id"))  # about MAX_POSITIVE ids
    n = docs.count()
    unlabelled = _texts(docs.filter(share(F.lit(min(1.0, MAX_UNLABELLED / max(1, n))), "doc_id", "text")))
    if not len(positive) or not len(unlabelled):
        return None
    mean, scale = unlabelled.mean(axis=0), np.full(unlabelled.shape[1], GRAM_SCALE, np.float32)
    scale[-SHAPES:] = np.maximum(unlabelled[:, -SHAPES:].std(axis=0), 1e-3)
    mean[-1], scale[-1] = 0, 1
    w = fit_nnpu((positive - mean) / scale, (unlabelled - mean) / scale, prior)
    return QualityModel(w.astype(np.float32), mean, scale)


def _texts(rows: DataFrame) -> np.ndarray:
    """Feature rows of a bounded sample, made inside the tasks, in an order of their own."""
    width = DIMS + SHAPES

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                for a, b in groups_of(part.num_rows):
                    x = vectors(texts_of(part.slice(a, b - a), "text"))
                    yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x.astype(np.float16)])], ["x"])

    found = sorted(bytes(r.x) for r in rows.select("text").mapInArrow(run, "x binary").collect())
    return np.frombuffer(b"".join(found), np.float16).reshape(len(found), width).astype(np.float32)


def predict(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``docs`` with score and predicted (input columns of these names are replaced)."""
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                for a, b in groups_of(part.num_rows):
                    some = part.slice(a, b - a)
                    scores = model.scores(texts_of(some, "text")).astype(float)
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(scores), pa.array((scores >= GOOD).astype(np.int32))],
                        [*some.schema.names, "score", "predicted"])

    schema = docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return docs.mapInArrow(run, schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", held_out(F.col("doc_id")))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    model = train(docs.filter(~F.col("held_out")), labels)
    return predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op9_quality_classifier": op9_quality_classifier}
