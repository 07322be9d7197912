"""Quality classifier: Bradley-Terry scores from preference pairs.

A document's score is linear in features of its whole text. Every good document is preferred
to every bad one; the weights minimise the logistic loss on feature differences of such
pairs. The decision threshold is the score quantile at the share of bad labels; scores are
mapped by a logistic curve that passes 0.3 there.

The fit reads a bounded sample of labelled rows (``max_labels``, the smallest hashes of the
id), outside the held-out fold; scoring covers every row.

Defined edge cases: a null text counts as empty and is scored like an empty text; equal
texts get equal scores; without labels of both kinds every score is 0.5; null labels are
ignored; repeated labels count as often as they occur; an empty table gives no row; other
columns are ignored and never enter a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ACCEPT = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the held-out fold; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(text: str) -> list[float]:
    """Shape of a text: length, vocabulary, character classes, repetition, marks."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by = np.bincount(raw, minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, w, m = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    lower, upper, digits, wide = by[97:123].sum(), by[65:91].sum(), by[48:58].sum(), by[192:].sum()
    space = by[32] + by[9] + by[10] + by[13]
    marks = len(text) - lower - upper - digits - wide - space
    kinds, pairs = len(set(words)), len(set(zip(words, words[1:])))
    return [
        math.log1p(len(text)), math.log1p(len(words)), (len(text) - space) / w, kinds / w, math.log1p(kinds) / math.log1p(w), pairs / w,
        lower / n, upper / n, digits / n, wide / n, marks / n, space / n, len(set(lines)) / m, math.log1p(n / m),
        by[46] / w, by[44] / w, by[33] / w, by[124] / w, (by[35] + by[36] + by[37] + by[38] + by[42]) / w, by[10] / w,
        sum(map(str.isupper, words)) / w, kinds / w * math.log1p(w),
    ]


WIDTH = 22


@dataclass
class Ranker:
    """Weights over standardised features and their squares; score maps to [0, 1]."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (self.design(x) * self.weights).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        at = np.clip(self.slope * (self.raw(x) - self.threshold), -30, 30)
        return 1 / (1 + (1 - ACCEPT) / ACCEPT * np.exp(-at))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = 40_000, penalty: float = 1e-2, steps: int = 25, seed: int = 7) -> Ranker:
    """Newton steps on the pairwise logistic loss."""
    x = x.reshape(-1, WIDTH)
    scale = x.std(axis=0) if len(x) else np.ones(WIDTH)
    model = Ranker(x.mean(axis=0) if len(x) else np.zeros(WIDTH), np.where(scale > 1e-9, scale, 1), np.zeros(2 * WIDTH), 0.0, 1.0)
    better, worse = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(better) or not len(worse):
        return model
    rng = np.random.default_rng(seed)
    z = model.design(x)
    d = z[rng.choice(better, pairs)] - z[rng.choice(worse, pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        grad = -(d * p[:, None]).mean(axis=0) + penalty * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    model.weights = w
    raw = model.raw(x)
    model.threshold = float(np.quantile(raw, len(worse) / len(x)))
    spread = float(np.median(raw[better]) - np.median(raw[worse]))
    model.slope = 6 / max(spread, 1e-6)
    return model


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 12_000) -> Ranker:
    """A ranker from the labelled rows outside the held-out fold."""
    own = labels.select("doc_id", "quality").where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labels)  # at most max_labels rows of two numbers
    found = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = sorted((r["doc_id"], r["quality"], r["x"]) for r in found.mapInArrow(run, "doc_id long, quality int, x array<double>").collect())
    return fit(np.array([r[2] for r in rows], float), np.array([r[1] for r in rows]))


def score(docs: DataFrame, model: Ranker, name: str = "score") -> DataFrame:
    """docs with the score in a column `name`, which takes the place of one of that name; all others are kept."""
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch.column("text").to_pylist()], float).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def accepted(docs: DataFrame, model: Ranker) -> DataFrame:
    """The rows of docs that the ranker accepts."""
    name = common.fresh(docs, "score")
    return score(docs, model, name).where(F.col(name) >= ACCEPT).drop(name)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
