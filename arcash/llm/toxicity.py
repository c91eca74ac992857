"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams (operator 3).

Features of a whole text, each present or absent, hashed to ``2**bits`` coordinates: words,
word stems (a word's first letters), word pairs, and pairs that skip one word. Training
visits the sample's texts one by one; every coordinate has its own learning rate, only
coordinates of ``min_rows`` texts at least are let in, and the L1 term keeps all but a few
weights at zero, so the broadcast model is the short list of non-zero weights (at most
``2**bits`` of them, 4 MB). Scores are calibrated: a logistic line is fitted to the scores
that models of the other folds give each row of the sample.

The model is fitted on a documented, bounded sample: the ``max_rows`` labelled documents
least by a hash of their id. Of rows that repeat a sampled id, the least text trains. Scoring runs over every document, in one pass and no shuffle.

Defined results: a null or empty text gets the score of the intercept alone; a document
marked toxic in any of several label rows counts as toxic; null labels are left out; with
no labelled rows at all the weights are zero and every score is 0.5; an empty table gives
an empty result; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import MIX1, ROLL, BoundedCache, mix64, read, ship, word_hash, worker_state

ship(__name__)

WORD = re.compile(r"[^\W_]+")
STEM = 4


def _hash_pair(word: str) -> tuple[int, int]:
    return word_hash(word.encode("utf-8", "surrogatepass")), \
        word_hash(b"\x00" + word[:STEM].encode("utf-8", "surrogatepass"))


def features(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct coordinates of a text."""
    cache = worker_state("toxicity", "words", lambda: BoundedCache(_hash_pair, 300_000))
    words = WORD.findall((text or "").lower())
    pairs = np.array([cache[w] for w in words], np.uint64).reshape(-1, 2)
    w, stem = pairs[:, 0], pairs[:, 1]
    with np.errstate(over="ignore"):
        near = mix64(w[:-1] * ROLL + w[1:])
        skip = mix64(w[:-2] * MIX1 + w[2:])
    at = np.concatenate([w, stem, near, skip]) >> np.uint64(64 - bits)
    return np.unique(at).astype(np.int32)


class Ftrl:
    """FTRL-proximal with per-coordinate rates, over lists of present coordinates."""

    def __init__(self, bits: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 2.0,
                 l2: float = 1.0):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.intercept, self.n0 = 0.0, 0.0
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z)
                        / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: float, weight: float = 1.0) -> None:
        w, n = self.weights(at), self.n[at]
        s = np.clip(w.sum() + self.intercept, -35, 35)
        g = weight * (1.0 / (1.0 + np.exp(-s)) - label)
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.n0 += g * g               # the intercept: its own rate, no L1
        self.intercept -= self.alpha / (self.beta + np.sqrt(self.n0)) * g

    def fit(self, rows: list[np.ndarray], labels, epochs: int = 5, min_rows: int = 1,
            max_clean: float = 0.1, positive_weight: float = 1.0, seed: int = 7) -> "Ftrl":
        """Coordinates of few rows, or common in rows of label 0, are left out: a text's
        score then rests on evidence in it, and a short text isn't judged by what it lacks."""
        rng = np.random.default_rng(seed)
        seen, clean = np.zeros(len(self.z), np.int32), np.zeros(len(self.z), np.int32)
        for at, y in zip(rows, labels):
            seen[at] += 1
            if not y:
                clean[at] += 1
        negatives = max(1, int((np.asarray(labels) == 0).sum()))
        use = (seen >= min_rows) & (clean <= max(1, max_clean * negatives))
        rows = [at[use[at]] for at in rows]
        share = np.clip(1 - negatives / max(1, len(rows)), 0.01, 0.99)
        self.intercept = float(np.log(share / (1 - share)))
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                self.learn(rows[i], labels[i], positive_weight if labels[i] else 1.0)
        return self


def platt(s: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic line from scores to labels, lightly held to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * s + b, -35, 35)))
        v = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * s).sum() + 0.1 * (a - 1.0), (p - y).sum() + 0.1 * b])
        h = np.array([[(v * s * s).sum() + 0.1, (v * s).sum()], [(v * s).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def training_sample(docs: DataFrame, labels: DataFrame, target: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents, by least id hash."""
    marked = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(target).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # bounded: max_rows rows of two numbers; rows that repeat a doc_id train as one
    return (docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")))


class Model:
    """Compact weights, and the calibration line."""

    def __init__(self, at: np.ndarray, weight: np.ndarray, slope: float, shift: float, bits: int):
        self.at, self.weight, self.slope, self.shift, self.bits = at, weight, slope, shift, bits

    def scorer(self):
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.at] = self.weight

        def one(text) -> float:
            s = float(dense[features(text, self.bits)].sum(dtype=np.float64))
            return 1.0 / (1.0 + np.exp(-np.clip(self.slope * s + self.shift, -35, 35)))
        return one


def train(rows: list[np.ndarray], labels: np.ndarray, bits: int, folds: int = 4,
          min_rows: int = 4, positive_weight: float = 1.0) -> Model:
    """Fit all rows; calibrate on scores that each row gets from the other folds' model."""
    def learn(which):
        m = Ftrl(bits).fit([rows[i] for i in which], labels[which], min_rows=min_rows,
                           positive_weight=positive_weight)
        return m.weights(slice(None)), m.intercept

    if len(rows) == 0:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 1.0, 0.0, bits)
    of, s = np.arange(len(rows)) % folds, np.zeros(len(rows))
    for k in range(min(folds, len(rows))):
        w, b = learn(np.flatnonzero(of != k))
        for i in np.flatnonzero(of == k):
            s[i] = w[rows[i]].sum() + b
    w, b = learn(np.arange(len(rows)))
    at = np.flatnonzero(w)
    slope, shift = platt(s, labels)
    return Model(at.astype(np.int32), w[at].astype(np.float32), slope, slope * b + shift, bits)


def fit(docs: DataFrame, labels: DataFrame, bits: int = 20, max_rows: int = 12_000,
        target: str = "toxic") -> Model:
    """Train on the bounded sample."""
    @F.pandas_udf("array<int>")
    def coordinates(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, bits) for t in texts])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable", ignore_index=True)
        m = train([np.asarray(a, np.int32) for a in pdf["at"]], pdf["label"].to_numpy(float), bits)
        return pd.DataFrame({"at": [m.at], "weight": [m.weight], "slope": [m.slope], "shift": [m.shift]})

    sample = training_sample(docs, labels, target, max_rows).select(
        F.lit(0).alias("all"), "doc_id", "label", coordinates("text").alias("at"))
    # the whole sample trains in one task (it is bounded by max_rows); the driver gets weights
    got = sample.groupBy("all").applyInPandas(
        learn, "at array<int>, weight array<float>, slope double, shift double").collect()
    if not got:
        return train([], np.zeros(0), bits)
    return Model(np.array(got[0]["at"], np.int32), np.array(got[0]["weight"], np.float32),
                 got[0]["slope"], got[0]["shift"], bits)


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a score between 0 and 1 for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = sent.value.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")
    return docs.withColumn(out, toxicity(F.col(text)))


def fold() -> F.Column:
    """True for the held-out fifth: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained_scores(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(~fold())
    return score(docs, fit(docs, labels), out=out)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return trained_scores(spark, docs, sf_dir, "score").select(
        "doc_id", fold().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
