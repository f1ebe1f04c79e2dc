"""Bounded samples of labelled documents, and logistic calibration on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): one row per labelled document that is not held out; of several labels the smallest counts."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder(F.col("doc_id")) != 0))
            .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))


def sample_labels(train: DataFrame, per_class: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class[y]`` rows of each class in hash order, and the classes' full counts."""
    counts = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}  # two rows
    order = F.xxhash64(F.lit("sample"), "doc_id")
    parts = [train.filter(F.col("y") == y).orderBy(order, "doc_id").limit(n) for y, n in per_class.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, {y: counts.get(y, 0) for y in per_class}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> dict:
    """Ridge logistic regression by Newton's method; features are standardised."""
    mean, dev = x.mean(axis=0), x.std(axis=0)
    dev[dev == 0] = 1.0
    z = np.c_[np.ones(len(x)), (x - mean) / dev]
    beta = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(b):
        t = z @ b
        return (weight * (np.logaddexp(0, t) - y * t)).sum() + 0.5 * (penalty * b * b).sum()

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -35, 35)))
        grad = z.T @ (weight * (p - y)) + penalty * beta
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return {"mean": mean.tolist(), "dev": dev.tolist(), "beta": beta.tolist()}


def apply_logistic(model: dict, x: np.ndarray) -> np.ndarray:
    z = (x - np.array(model["mean"])) / np.array(model["dev"])
    t = model["beta"][0] + z @ np.array(model["beta"][1:])
    return 1 / (1 + np.exp(-np.clip(t, -35, 35)))
