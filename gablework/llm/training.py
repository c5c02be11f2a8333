"""Bounded samples of labelled documents, and the fits made on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from gablework.llm.common import text_or_empty
from gablework.session import stage


def fold(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int, text: str = "text", *more: str) -> DataFrame:
    """(doc_id, label, text, ...) of at most ``bound`` labelled documents, chosen by hash of the id.

    ``usable`` says which label rows may be learned from.  Contradicting labels
    of one document count as the greater; null labels do not count.  The ids chosen
    are bounded, so their join is a broadcast.
    """
    known = labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("__label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    chosen = stage(chosen, "labels")
    body = docs.select("doc_id", text_or_empty(text).alias("text"), *more)
    return stage(body.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "sample")


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the last one constant, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = logistic(x @ weights)
        slope = x.T @ (p - y) + keep * weights
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        move = np.linalg.solve(bend, slope)
        weights -= move / max(1.0, np.abs(move).max() / 3)
        if np.abs(move).max() < 1e-8:
            break
    return weights
