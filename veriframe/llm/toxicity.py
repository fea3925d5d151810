"""Toxicity by logistic regression over hashed words, n-grams and skip-grams, trained by FTRL-proximal."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.shared import slices, with_columns

#: Hashed features; the dense weights of a model take four times as many bytes.
SIZE = 1 << 18
#: Labelled rows that a model is fitted on at most, and characters of a text that may be among them.
SAMPLE, SAMPLE_CHARS = 6_000, 20_000
THRESHOLD = 0.3
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 8.0, 1.0, 3
#: Distance of the two words of a pair: 1 is a bigram, the others are skip-grams.
GAPS = (1, 2)
_WORDS = re.compile(r"[^\W_]+").findall
_REMEMBERED = 500_000


class Features:
    """Feature numbers of words, remembered by name."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        names = _WORDS(text.lower())
        found = list(map(self.known.get, names))
        if None in found:
            if len(self.known) > _REMEMBERED:
                self.known = {}
            for name in names:
                if name not in self.known:
                    self.known[name] = zlib.crc32(name.encode())
            found = list(map(self.known.get, names))
        return np.array(found, np.uint64)

    def of(self, text: str) -> np.ndarray:
        """Distinct features of a text: words, and pairs of words up to the largest gap apart."""
        return np.unique(self.all_of(text))

    def all_of(self, text: str) -> np.ndarray:
        words = self.words(text)
        parts = [words * np.uint64(0x9E3779B97F4A7C15)]
        for gap in GAPS:
            if len(words) > gap:
                parts.append((words[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + words[gap:] * np.uint64(0x165667B19E3779F9) + np.uint64(gap)) * np.uint64(0x9E3779B97F4A7C15))
        return (np.concatenate(parts) >> np.uint64(46)).astype(np.int64)


def sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(texts: list[str], labels: list[int], seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Numbers and values of the weights other than zero, and the constant.

    Every coordinate has its own rate, falling with its gradients so far; weights
    whose summed gradient stays below the L1 bound are exactly zero.
    """
    features = Features()
    rows = [features.of(t or "").astype(np.int32) for t in texts]
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    order = np.random.default_rng(seed)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            at = np.append(rows[k], SIZE)
            zk, nk = z[at], n[at]
            bound = np.full(len(at), L1)
            bound[-1] = 0.0
            w = np.where(np.abs(zk) <= bound, 0.0, (np.sign(zk) * bound - zk) / ((BETA + np.sqrt(nk)) / ALPHA + L2))
            g = sigmoid(w.sum()) - labels[k]
            z[at] += g - (np.sqrt(nk + g * g) - np.sqrt(nk)) / ALPHA * w
            n[at] += g * g
    bound = np.full(SIZE + 1, L1)
    bound[-1] = 0.0
    w = np.where(np.abs(z) <= bound, 0.0, (np.sign(z) * bound - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    used = np.flatnonzero(w[:SIZE])
    return used, w[used].astype(np.float32), float(w[SIZE])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> list[tuple[str, int]]:
    """Texts and labels of at most ``SAMPLE`` labelled rows, the same ones for the same rows.

    Rows are taken in the order of a hash of their id, without texts of over
    ``SAMPLE_CHARS`` characters. A document with several labels counts for each.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("label is not null")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(2 * SAMPLE)
    joined = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text").limit(SAMPLE)
    return [(r["text"], r["label"]) for r in joined.select("text", "label").toLocalIterator()]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """A model of the labelled rows; without any it answers one half for every text."""
    rows = sample(docs, labels, doc_id, text, label)
    return fit([r[0] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", out: str = "score") -> DataFrame:
    """The rows with the probability of label 1.

    Whole texts are read; null and empty ones have the probability that the constant
    gives. Rows are independent. A column of the result's name is replaced.
    """
    kept = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        numbers, values, constant = sent.value
        weights = np.zeros(SIZE, np.float32)
        weights[numbers] = values
        used = weights != 0
        features = Features()

        def one(content: str) -> float:
            found = features.all_of(content)
            return float(sigmoid(constant + weights[np.unique(found[used[found]])].sum(dtype=np.float64)))

        for batch, texts in slices(batches, text):
            yield with_columns(batch, {out: pa.array([one(t) for t in texts], pa.float64())})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))
