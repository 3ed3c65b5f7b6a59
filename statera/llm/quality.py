"""Quality scores: random Fourier features, ridge by normal equations, isotonic calibration.

Every text gives a vector of statistics (lengths, shares of kinds of characters, repetition, byte
entropy). ``FEATURES`` cosines of random projections approximate a Gaussian kernel over the
standardised vector. Each partition sums its part of the normal equations; the sums are added by
Spark, and the one system of fixed size is solved on the driver. Raw scores of a fold that the
ridge hasn't seen are counted on a fixed grid and made monotone by pooling adjacent violators.
All labelled rows are used but the held-out ones (crc32 of the id as text, modulo 4, is 2): those
with remainder 3 calibrate, the others fit. Labels, lang, source and id are never inputs of a score.

Several labels of one id are averaged; null labels and ids are left out. Without labelled rows
nothing can be told apart and every score is 1. Null and empty texts have a vector of zeros and a
score like any other. Without labelled rows in the calibration fold raw scores are taken as they are, cut to 0 and 1.
Repeated rows score alike; ``held_out`` is null for a null id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc32_mod, landed, scratch, table

FEATURES, WIDTH, RIDGE, SEED = 128, 2.0, 1e-3, 20240229
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
THRESHOLD = 0.7
BINS, LOW, HIGH = 2048, -0.5, 1.5  # the grid of raw scores

KINDS = {  # classes of bytes; bytes of 128 and more are parts of letters
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "white": b" \t\n\r\x0b\x0c",
    "line": b"\n", "stop": b".", "comma": b",;:", "shout": b"!?", "quote": b"'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~"}
MASKS = np.zeros((256, len(KINDS)))
for _i, _chars in enumerate(KINDS.values()):
    MASKS[list(_chars), _i] = 1.0
N_STATS = 10 + len(KINDS)


def statistics(text: bytes | None) -> np.ndarray:
    out = np.zeros(N_STATS)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    out[:len(KINDS)] = counts @ MASKS / n
    p = counts[counts > 0] / n
    words = text.split()
    lines = text.split(b"\n")
    at = len(KINDS)
    out[at:at + 3] = np.log1p(n), np.log1p(len(words)), -(p * np.log(p)).sum()
    if words:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        alike: dict[bytes, int] = {}
        for w in words:
            alike[w] = alike.get(w, 0) + 1
        out[at + 3:at + 8] = (sizes.mean(), sizes.std(), np.log1p(sizes.max()), len(alike) / len(words),
                              max(alike.values()) / len(words))
    out[at + 8] = 1 - len(set(lines)) / len(lines)
    out[at + 9] = np.log1p(len(words) / (1 + counts[46]))
    return out


def _stats_of(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, N_STATS))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    grid: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        d = x.shape[1]
        w, b = rng.normal(0, 1 / (WIDTH * np.sqrt(d)), (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / FEATURES) * np.cos(x @ w + b)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.ones(len(x))
        return np.interp(self.raw(x), self.grid, self.values)


def monotone(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Weighted isotonic fit by pooling adjacent violators."""
    blocks: list[list[float]] = []  # weight, mean, length
    for w, v in zip(weight, value, strict=True):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(int(n), v) for _, v, n in blocks]) if blocks else np.zeros(0)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    work = scratch(spark, "quality")
    bounded_batches(spark)
    fold = crc32_mod(F.col("doc_id"), FOLDS)
    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").cast("double").alias("y"))
    text = F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text")
    seen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text).where(fold != HELD_OUT)

    def stats(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"doc_id": part["doc_id"], "x": list(_stats_of(part["text"]))})
    known = landed(seen.mapInPandas(stats, "doc_id long, x array<double>").join(truth, "doc_id")
                   .withColumn("fold", fold), f"{work}/known")

    fit = known.where(F.col("fold") != CALIBRATION)
    moments = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i") \
        .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).orderBy("i").collect()  # a row a statistic
    if not moments:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(0), np.zeros(1), np.ones(1))
    model = Model(np.array([m["mean"] for m in moments]),
                  np.array([m["sd"] if m["sd"] > 1e-9 else 1.0 for m in moments]), np.zeros(0), np.zeros(1), np.ones(1))

    def normal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = FEATURES + 2
        total = np.zeros((size, size))
        for part in parts:
            if len(part):
                z = np.hstack([model.features(np.stack(part["x"])), part[["y"]].to_numpy()])
                total += z.T @ z
        if total.any():
            i, j = np.triu_indices(size)
            yield pd.DataFrame({"i": i, "j": j, "v": total[i, j]})
    sums = fit.select("x", "y").mapInPandas(normal, "i int, j int, v double").groupBy("i", "j") \
        .agg(F.sum("v").alias("v")).collect()  # (FEATURES + 2) squared, halved
    total = np.zeros((FEATURES + 2, FEATURES + 2))
    for i, j, v in sums:
        total[i, j] = total[j, i] = v
    gram, right = total[:-1, :-1], total[:-1, -1]
    model = Model(model.mean, model.scale, np.linalg.solve(gram + RIDGE * gram[0, 0] * np.eye(len(gram)), right),
                  np.zeros(1), np.ones(1))

    def binned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                at = np.clip((model.raw(np.stack(part["x"])) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1)
                yield pd.DataFrame({"bin": at.astype(np.int32), "y": part["y"]})
    rows = known.where(F.col("fold") == CALIBRATION).select("x", "y").mapInPandas(binned, "bin int, y double") \
        .groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()  # BINS at most
    if not rows:
        return Model(model.mean, model.scale, model.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    grid = LOW + (np.array([r["bin"] for r in rows]) + 0.5) * (HIGH - LOW) / BINS
    values = monotone(np.array([float(r["n"]) for r in rows]), np.array([r["y"] for r in rows]))
    return Model(model.mean, model.scale, model.weights, grid, np.clip(values, 0, 1))


def score_of(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_stats_of(texts)))
    return score(F.coalesce(text, F.lit("")).cast("binary"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         score_of(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
