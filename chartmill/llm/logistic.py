"""Labelled samples of bounded size, and logistic regression on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.common import saved

#: Most labelled documents of a class that a model is fitted on.
MOST_LABELLED = 4_000


def held_out(doc_id: str) -> Column:
    """One document in five, by CRC-32 of its id as text; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, columns: list[str], most: int = MOST_LABELLED, doc_id: str = "doc_id"
) -> tuple[DataFrame, dict[int, int]]:
    """Documents with a label, not held out: ``id``, ``columns``, ``y`` (0 or 1); and how many labels each class has.

    At most ``most`` of a class, drawn by a hash of the id. An id with several labels has the largest; one with several
    documents counts once; labels other than 0 and 1, and null ids, do not count. The drawn labels are so few that
    they are broadcast, and texts of other documents do not move.
    """
    usable = labels.where(~held_out(doc_id) & F.col(f"`{label}`").isin(0, 1) & F.col(f"`{doc_id}`").isNotNull())
    each = usable.groupBy(F.col(f"`{doc_id}`").alias("l_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
    drawn = None
    for y in (0, 1):
        some = each.where(F.col("y") == y).orderBy(F.xxhash64("l_id"), "l_id").limit(most)
        drawn = some if drawn is None else drawn.unionByName(some)
    drawn = saved(drawn)
    sizes = {r["y"]: r["count"] for r in each.groupBy("y").count().collect()}
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), *[F.col(f"`{c}`") for c in columns])
    met = rows.join(F.broadcast(drawn), F.col("id") == F.col("l_id")).drop("l_id").dropDuplicates(["id"])
    return saved(met), sizes


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Rows of ones at given columns."""

    def __init__(self, rows: list, width: int, values: list | None = None):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.array([c for r in rows for c in r], np.int64)
        self.value = np.ones(len(self.col)) if values is None else np.array([v for r in values for v in r], float)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], minlength=self.n)

    def t_dot(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * r[self.row], minlength=self.width)


def fit(
    x, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, pairs: Sparse | None = None, even: float = 0.0, rounds: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression; ``x`` has dot and t_dot (or is a matrix).

    Minimises the weighted mean loss + l2/2 |w|^2 + even/2 * mean((pairs w)^2): with ``pairs`` of feature differences,
    the last term keeps the scores of the two sides of each pair together. Plain accelerated descent (Adam), no
    random numbers.
    """
    dense = isinstance(x, np.ndarray)
    width = x.shape[1] if dense else x.width
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    weight = weight / weight.sum()
    for t in range(1, rounds + 1):
        r = (sigmoid((x @ w if dense else x.dot(w)) + b) - y) * weight
        g = np.append((x.T @ r if dense else x.t_dot(r)) + l2 * w, r.sum())
        if pairs is not None and pairs.n and even:
            g[:-1] += even * pairs.t_dot(pairs.dot(w)) / pairs.n
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = 0.1 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    return w, float(b)


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give each class of a drawn sample the share it has among all labels."""
    drawn = np.bincount(y.astype(int), minlength=2)
    return np.array([sizes.get(k, 0) / max(drawn[k], 1) for k in (0, 1)])[y.astype(int)]
