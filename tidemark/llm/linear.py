"""Logistic regression on bounded samples, and choosing such samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 1024  # that are multiplied at once


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None,
                 rounds: int = 25) -> np.ndarray:
    """Coefficients (the last is the intercept, not shrunk) by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (y - p)) - penalty * beta
        worth = weight * np.maximum(p * (1 - p), 1e-6)
        curve = np.diag(penalty)
        for low in range(0, len(x), ROWS):  # no second copy of x
            part = x[low:low + ROWS]
            curve += (part * worth[low:low + ROWS, None]).T @ part
        step = np.linalg.solve(curve, slope)
        beta += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def predict(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """The logit."""
    return x @ beta[:-1] + beta[-1]


def labelled_ids(labels: DataFrame, label: str, allowed: Column, each: tuple[int, int], seed: int) -> DataFrame:
    """At most ``each`` doc_ids of class 0 and of class 1, chosen by a hash; a doc_id with several labels has the largest."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).withColumn("draw", F.xxhash64("doc_id", F.lit(seed))))
    picked = [known.filter(F.col("label") == value).orderBy("draw", "doc_id").limit(each[value]) for value in (0, 1)]
    return picked[0].unionByName(picked[1]).select("doc_id", "label")
