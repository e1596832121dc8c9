"""Label folds, bounded training samples and the small learners of the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: Column) -> Column:
    """Rows that no learner sees: crc32 of the id as text leaves 2 when divided by 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample_ids(rows: DataFrame, bound: int, seed: int) -> DataFrame:
    """The ``bound`` rows whose ids hash lowest: the same in each run, and never more."""
    return rows.orderBy(F.xxhash64(F.lit(seed), "__id"), "__id").limit(bound)


def labelled_sample(labels: DataFrame, label: str, bound: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """(__id, __y) of at most ``bound`` labelled ids outside the held-out fold; a repeated id takes its largest label."""
    rows = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isin(0, 1) & ~held_out(F.col(f"`{id_col}`")))
    return sample_ids(rows.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max(f"`{label}`").cast("int").alias("__y")), bound, seed)


def texts_of(docs: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """ids (at most a bounded sample, so broadcast) with their texts, one row an id."""
    rows = docs.select(F.col(f"`{id_col}`").alias("__doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    return rows.join(F.broadcast(ids), F.col("__doc") == F.col("__id")).drop("__doc")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that what is made of their texts stays small."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.p, self.rate, self.k = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.k += 1
        for p, g, m, v in zip(self.p, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.k)) / (np.sqrt(v / (1 - 0.999**self.k)) + 1e-8)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps. Labels are smoothed, so that separable data stay finite."""
    a = np.column_stack([x, np.ones(len(x))])
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.zeros(a.shape[1])
    reg = np.full(a.shape[1], l2 * len(a))
    reg[-1] = 1e-9
    for _ in range(rounds):
        p = sigmoid(a @ w)
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(reg)
        d = np.linalg.solve(h, a.T @ (p - t) + reg * w)
        w -= np.clip(d, -5, 5)
        if np.abs(d).max() < 1e-7:
            break
    return w
