"""Quality by the votes of the nearest labelled texts in a latent-semantic space.

Texts become counts of character pairs and of a few traits of their words. A bounded sample
of labelled texts gives weights, a singular value decomposition and the labelled vectors;
these are broadcast, and each text meets all of them in exact blocked cosine products.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import fresh, small_batches

SAMPLE = 2048  # labelled texts at most, which bounds the model and what the driver holds
RANK = 32
NEIGHBOURS = 15
BLOCK = 128
TERM_BLOCK = 512


def _classes() -> bytes:
    """A class below 64 for each byte: letters a-z, capitals, digits, marks, white space, others."""
    out = bytearray(256)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = 60
        elif c.islower():
            out[b] = b - 97
        elif c.isupper():
            out[b] = 26
        elif c.isdigit():
            out[b] = 27
        elif c == " ":
            out[b] = 28
        elif c.isspace():
            out[b] = 29
        elif b < 32 or b == 127:
            out[b] = 61
    for i, c in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
        out[ord(c)] = 30 + i if i < 30 else 62
    return bytes(out)


CLASSES = _classes()
PAIRS = 64 * 64
# Shares of words that repeat the one before, of distinct words, and lengths, in steps.
REPEATS = np.array([0.01, 0.03, 0.08, 0.2, 0.4])
DISTINCT = np.array([0.2, 0.35, 0.5, 0.7, 0.9])
LENGTHS = np.array([1, 4, 16, 64, 256])
TERMS = PAIRS + 18


def terms(text: str | None) -> np.ndarray:
    """Term weights of a whole text: logarithms of counts, before weighting by rarity."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-8", "replace").translate(CLASSES), np.uint8).astype(np.int64)
    out = np.zeros(TERMS, np.float32)
    if len(codes) > 1:
        counts = np.bincount(codes[:-1] * 64 + codes[1:], minlength=PAIRS)
        out[:PAIRS] = np.sqrt(counts / (len(codes) - 1))
    words = text.split()
    n = max(len(words), 1)
    same = sum(map(operator.eq, words, words[1:])) / n
    out[PAIRS + np.searchsorted(REPEATS, same, "right")] = 0.4
    out[PAIRS + 6 + np.searchsorted(DISTINCT, len(set(words)) / n, "right")] = 0.1
    out[PAIRS + 12 + np.searchsorted(LENGTHS, len(words), "right")] = 0.1
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of terms
    axes: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled texts x rank, of length 1
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _projected(counts * self.weights, self.axes)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Votes for label 1 among the nearest labelled vectors, by their similarity."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        k = min(NEIGHBOURS, len(self.labels))
        out = []
        for at in range(0, len(texts), BLOCK):
            near = self.latent(np.stack([terms(t) for t in texts[at : at + BLOCK]])) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, 1), 1e-6).astype(np.float64) ** 4
            out.append((weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1))
        return np.concatenate(out) if out else np.empty(0)


def _projected(weighted: np.ndarray, axes: np.ndarray) -> np.ndarray:
    v = weighted @ axes
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def packed(counts: np.ndarray) -> bytes:
    """The places of the weights that are not zero, then these weights."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + counts[at].tobytes()


def unpack(data: bytes, out: np.ndarray) -> None:
    n = len(data) // 6
    out[np.frombuffer(data, np.uint16, n)] = np.frombuffer(data, np.float32, n, 2 * n)


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Weights by rarity, axes and labelled vectors of a sample of texts.

    This runs on the driver, so `counts`, the largest part, is weighted in place.
    """
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    seen = (counts > 0).sum(axis=0)
    weights = (1 + np.log((1 + len(counts)) / (1 + seen))).astype(np.float32)
    counts *= weights
    values, left = np.linalg.eigh((counts @ counts.T).astype(np.float64))
    top = [i for i in np.argsort(-values)[:RANK] if values[i] > 1e-9 * max(values[-1], 1e-9)]
    left = left[:, top]
    # in double precision, some terms at a time
    axes = np.concatenate([counts[:, lo : lo + TERM_BLOCK].T @ left for lo in range(0, TERMS, TERM_BLOCK)])
    axes = (axes / np.sqrt(values[top])).astype(np.float32)
    return Model(weights, axes, _projected(counts, axes).astype(np.float32), labels)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def learn(df: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Model of a labelled sample of at most `sample` texts, half of them of each label if there are.

    Texts are chosen by a hash of their key, among labelled ones that are not held out. Keys
    with contradicting labels or without a label don't take part. Of rows that repeat a key
    the least text counts.
    """
    of_key = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    of_key = of_key.groupBy(key).agg(F.min(label).alias("label"), F.max(label).alias("most")).where("label = most")
    chosen = None
    for value in (0, 1):
        part = of_key.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(sample // 2).select(F.col(key).alias("k"), F.col("label").cast("int"))
        chosen = part if chosen is None else chosen.unionByName(part)

    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([packed(terms(t)) for t in texts])

    # at most `sample` rows of two numbers, which is what makes this broadcast safe
    texts = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(chosen), "k")
    texts = texts.groupBy("k", "label").agg(F.min("t").alias("t"))
    rows = sorted(texts.select("k", "label", counted("t").alias("c")).collect(), key=lambda r: r["k"])
    counts = np.zeros((len(rows), TERMS), np.float32)
    for r, out in zip(rows, counts):
        unpack(r["c"], out)
    return fit(counts, np.asarray([r["label"] for r in rows], np.float64))


def score_quality(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 from a half on).

    Only the text counts. Null and empty texts are scored like any other; without a labelled
    text the score is a half. Rows stay as they are; columns of these names are replaced.
    """
    spark = df.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.scores([t if isinstance(t, str) else None for t in texts]), dtype=float)

    scored = fresh(df, "score", "predicted").withColumn("score", F.round(score(F.col(f"`{text}`")), 6))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents with score and prediction of a model learnt from the labelled ones."""
    return score_quality(docs, learn(docs, labels))


def digests(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
