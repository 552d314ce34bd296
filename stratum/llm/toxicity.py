"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are its distinct character n-grams, hashed; each has the value of its
log-count ratio between the classes, and a text's vector has length 1. A logistic
regression is fitted on the driver on at most ``per_class`` labelled texts of each class,
taken by id hash, so the sample, what reaches the driver and the model (two arrays of
``BUCKETS``) are bounded at every input size. Every text is then scored whole, where it
lies, without a shuffle.

Defined results: null and empty texts have no features and get the model's intercept; a
label that is null is ignored, an id with several labels is toxic if one says so, and an
id with several texts trains on the least; without labels of both classes every score is
0. Rows whose id checks as held out never train; a row without an id is held out. Repeated
rows repeat their score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
SHORTEST, LONGEST = 3, 5
PER_CLASS = 1000
FOLDS = 5
ITERATIONS = 50
PENALTY = 1e-4
SMOOTHING = 1.0
HASH_LIMIT = 1_000_000
BLOCK_ROWS = 200


def features(text: str | None) -> np.ndarray:
    """Distinct buckets of the n-grams of a text, lower-cased, with single spaces around words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.int32)
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    seen = np.zeros(BUCKETS, bool)
    h = np.zeros(len(code), np.uint64)
    for n in range(1, LONGEST + 1):
        h = (h[:len(code) - n + 1] + code[n - 1:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n >= SHORTEST:
            seen[(h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


def packed(f: np.ndarray) -> bytes:
    """Buckets as 32-bit numbers, or as one bit per possible bucket where that is no longer."""
    if 32 * len(f) < BUCKETS:
        return f.tobytes()
    bits = np.zeros(BUCKETS, bool)
    bits[f] = True
    return np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if 8 * len(data) < BUCKETS:
        return np.frombuffer(data, np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8))).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Weights by bucket (ratio included), squared ratios for a text's length, intercept."""

    weight: np.ndarray
    square: np.ndarray
    intercept: float | None

    def score(self, text: str | None) -> float:
        if self.intercept is None:
            return 0.0
        f = features(text)
        norm = float(np.sqrt(self.square[f].sum(dtype=np.float64)))
        z = self.intercept + (float(self.weight[f].sum(dtype=np.float64)) / norm if norm > 0 else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Accelerated gradient descent on the logistic loss of the scaled features."""
    y = toxic.astype(np.float64)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), None)
    counts = [np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)]
    for f, t in zip(rows, y):
        counts[int(t)][f] += 1
    ratio = (np.log(counts[1] / (y.sum() + 2 * SMOOTHING))
             - np.log(counts[0] / (len(y) - y.sum() + 2 * SMOOTHING)))
    square = ratio ** 2
    inv = np.array([1 / max(np.sqrt(square[f].sum()), 1e-12) for f in rows])
    balance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    blocks = []
    for at in range(0, len(rows), BLOCK_ROWS):
        part = rows[at:at + BLOCK_ROWS]
        size = np.array([len(f) for f in part])
        blocks.append((slice(at, at + len(part)), np.concatenate(part), size))
    w, speed, b, b_speed = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for k in range(ITERATIONS):
        ahead, b_ahead = w + k / (k + 3) * speed, b + k / (k + 3) * b_speed
        slope, b_slope, scaled = np.zeros(BUCKETS), 0.0, (ahead * ratio).astype(np.float32)
        for at, f, size in blocks:
            owner = np.repeat(np.arange(len(size)), size)
            z = np.bincount(owner, scaled[f], len(size)) * inv[at] + b_ahead
            err = (1 / (1 + np.exp(-z)) - y[at]) * balance[at]
            slope += np.bincount(f, np.repeat(err * inv[at], size), BUCKETS)
            b_slope += err.sum()
        w_new, b_new = ahead - 2 * (slope * ratio + PENALTY * ahead), b_ahead - 2 * b_slope
        w, speed, b, b_speed = w_new, w_new - w, b_new, b_new - b
    return Model((w * ratio).astype(np.float32), square.astype(np.float32), float(b))


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def sample(labels: DataFrame, id_col: str = "doc_id", label: str = "toxic", per_class: int = PER_CLASS,
           folds: int = FOLDS) -> DataFrame:
    """(id, y): at most ``per_class`` training labels of each class, chosen by id hash."""
    known = (labels.select(F.col(id_col), F.col(label).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, folds))
             .groupBy(id_col).agg(F.max("y").alias("y")))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(id_col), F.lit(HASH_LIMIT))
    picked = None
    for y, n in sorted(sizes.items()):
        # twice the share, so that the limit after it, and not the hash, sets the number
        share = min(HASH_LIMIT, -(-2 * per_class * HASH_LIMIT // n))
        part = known.filter((F.col("y") == y) & (place < share)).orderBy(place, id_col).limit(per_class)
        picked = part if picked is None else picked.union(part)
    return known if picked is None else picked


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          label: str = "toxic", per_class: int = PER_CLASS, folds: int = FOLDS) -> Model:
    """Fit on the texts of the label sample."""
    picked = sample(labels, id_col, label, per_class, folds)
    texts = (docs.select(F.col(id_col), F.col(text).cast("string").alias("t"))
             .join(F.broadcast(picked), id_col)
             .groupBy(id_col).agg(F.min("t").alias("t"), F.max("y").alias("y")))

    @F.pandas_udf("binary")
    def buckets(t: pd.Series) -> pd.Series:
        return t.map(lambda x: packed(features(x)))

    # at most 2 * per_class rows of BUCKETS / 8 bytes
    got = texts.select("y", buckets("t").alias("f")).toPandas()
    rows = [unpacked(f) for f in got["f"]]
    order = np.argsort(got["y"].to_numpy(), kind="stable")
    return fit([rows[i] for i in order], got["y"].to_numpy()[order])


def scorer(spark: SparkSession, model: Model):
    """A vectorised column function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        m = shared.value
        return t.map(lambda x: m.score(x if isinstance(x, str) else None)).astype("float64")

    return score


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                    **options) -> DataFrame:
    """(id, held_out, score, predicted) per row."""
    score = scorer(docs.sparkSession, train(docs, labels, id_col, text, **options))
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"),
                         score(F.col(text).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that score below one half, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, id_col, text, **options))
    return docs.filter(score(F.col(text).cast("string")) < 0.5)
