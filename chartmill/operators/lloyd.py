"""K-Means of many numbers of groups and many starts at once.

Every Lloyd step of all (k, seed) pairs that still move is one pass over the rows: a task takes the distances of its
rows to all centres of all pairs with one matrix product, and hands on a count and a sum per pair and group, which Spark adds up.
Pairs stop one by one. Starts come from k-means++ on a bounded random sample (:data:`START_ROWS`), the steps read all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.operators.metric_index import matrix
from chartmill.workers import ship

#: Rows of the sample that starts are drawn from, about.
START_ROWS = 8_192
#: Rows whose distances to all centres are held together.
TOGETHER = 4_096


@dataclass(frozen=True)
class Fit:
    """Centres of one pair, the sum of squared distances to them, and the steps it took."""

    k: int
    seed: int
    centres: np.ndarray
    inertia: float
    steps: int


def plus_plus(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres drawn one by one with probability by squared distance; fewer where there are fewer different rows."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    nearest = ((sample - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and nearest.max() > 0:
        # The best of a few draws, as is usual.
        drawn = rng.choice(len(sample), size=2 + int(np.log(k)), p=nearest / nearest.sum())
        left = np.minimum(nearest, ((sample[drawn, None] - sample[None]) ** 2).sum(axis=2))
        best = int(left.sum(axis=1).argmin())
        centres.append(sample[drawn[best]])
        nearest = left[best]
    return np.array(centres)


def nearest_centres(x: np.ndarray, pairs: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """For each pair the place of each row's nearest centre, from one product with the centres of all."""
    stacked = np.concatenate(pairs)
    rough = (stacked * stacked).sum(axis=1) - 2.0 * (x @ stacked.T)
    at = 0
    for centres in pairs:
        yield rough[:, at : at + len(centres)].argmin(axis=1)
        at += len(centres)


def _step(vectors: DataFrame, pairs: dict[int, np.ndarray]) -> DataFrame:
    """(pair, cluster, n, cost, s): of each task; ``cost`` is the sum of squared distances to the centre."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {p: np.zeros(len(c)) for p, c in pairs.items()}
        cost = {p: np.zeros(len(c)) for p, c in pairs.items()}
        s = {p: np.zeros(c.shape) for p, c in pairs.items()}
        for b in batches:
            whole = matrix(b.column(0)) if len(b) else np.zeros((0, 1))
            for start in range(0, len(whole), TOGETHER):
                x = whole[start : start + TOGETHER]
                for (p, centres), own in zip(pairs.items(), nearest_centres(x, list(pairs.values()))):
                    member = np.zeros((len(x), len(centres)))
                    member[np.arange(len(x)), own] = 1.0
                    n[p] += member.sum(axis=0)
                    s[p] += member.T @ x
                    cost[p] += member.T @ ((x - centres[own]) ** 2).sum(axis=1)
        rows = [(p, c, n[p][c], cost[p][c], s[p][c]) for p in pairs for c in np.flatnonzero(n[p])]
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["pair", "cluster", "n", "cost", "s"])

    return vectors.mapInArrow(add, "pair int, cluster int, n double, cost double, s array<double>")


def _summed(parts: DataFrame) -> dict[int, dict[int, tuple[float, float, np.ndarray]]]:
    """Per pair and group: count, cost and sum. As many rows as centres reach the driver."""
    total = Summarizer.sum(array_to_vector("s")).alias("s")
    found: dict[int, dict[int, tuple[float, float, np.ndarray]]] = {}
    for r in parts.groupBy("pair", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), total).collect():
        found.setdefault(r["pair"], {})[r["cluster"]] = (r["n"], r["cost"], r["s"].toArray())
    return found


def fit_many(vectors: DataFrame, pairs: Sequence[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """A fit for each (k, seed). ``vectors`` has one column of arrays of doubles, full and of one length; hold it.

    A pair stops when no centre moves further than ``tol``. A centre without rows stays where it is. No rows: no fits.
    """
    ship(vectors.sparkSession)
    vectors = vectors.toDF("v")
    rows = vectors.count()
    if not rows:
        return []
    drawn = vectors.sample(fraction=min(1.0, START_ROWS / rows), seed=17).collect()
    sample = matrix(r["v"] for r in drawn or vectors.limit(1).collect())
    centres = {i: plus_plus(sample, k, seed) for i, (k, seed) in enumerate(pairs)}
    fits: dict[int, Fit] = {}
    moving = dict(centres)
    for step in range(1, max_iter + 1):
        sums = _summed(_step(vectors, moving))
        for p, old in list(moving.items()):
            new, cost = old.copy(), 0.0
            for c, (n, spent, s) in sums[p].items():
                new[c] = s / n
                # The same rows cost this much less around their mean.
                cost += spent - n * float(((new[c] - old[c]) ** 2).sum())
            fits[p] = Fit(*pairs[p], new, cost, step)
            moving[p] = new
            if float(((new - old) ** 2).sum(axis=1).max()) <= tol * tol:
                del moving[p]
        if not moving:
            break
    return [fits[i] for i in range(len(pairs))]


def squared_silhouettes(vectors: DataFrame, groupings: Sequence[np.ndarray]) -> list[float | None]:
    """Mean silhouette by squared distances of every grouping, two passes for all. None where there is one group.

    A row's mean squared distance to a group follows from the group's count, sum and sum of squares.
    """
    ship(vectors.sparkSession)
    vectors = vectors.toDF("v")
    pairs = dict(enumerate(groupings))
    stats = _summed(_step(vectors, pairs))
    held = {}
    for p, centres in pairs.items():
        found = sorted(stats.get(p, {}).items())
        n = np.array([v[0] for _, v in found])
        mean = np.array([v[2] / v[0] for _, v in found])
        # Mean squared distance of a group's rows from their own mean.
        spread = np.array([v[1] / v[0] - ((centres[c] - m) ** 2).sum() for (c, v), m in zip(found, mean)])
        held[p] = ([c for c, _ in found], n, mean, spread)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = dict.fromkeys(pairs, 0.0), 0
        for b in batches:
            whole = matrix(b.column(0)) if len(b) else np.zeros((0, 1))
            rows += len(whole)
            for start in range(0, len(whole), TOGETHER):
                x = whole[start : start + TOGETHER]
                for (p, _), own in zip(pairs.items(), nearest_centres(x, list(pairs.values()))):
                    numbers, n, mean, spread = held[p]
                    at, line = np.minimum(np.searchsorted(numbers, own), len(numbers) - 1), np.arange(len(x))
                    gap = np.stack([((x - m) ** 2).sum(axis=1) for m in mean], axis=1) + spread
                    a = gap[line, at] * n[at] / np.maximum(n[at] - 1, 1)
                    gap[line, at] = np.inf
                    b_ = gap.min(axis=1)
                    most = np.maximum(a, b_)
                    fine = (n[at] > 1) & (most > 0) & np.isfinite(b_)
                    total[p] += float(((b_[fine] - a[fine]) / most[fine]).sum())
        yield pa.RecordBatch.from_pydict({"pair": pa.array(list(total), pa.int32()), "s": pa.array(list(total.values())), "n": pa.array([rows] * len(total), pa.int64())})

    got = {r["pair"]: r for r in vectors.mapInArrow(score, "pair int, s double, n long").groupBy("pair").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    return [got[p]["s"] / got[p]["n"] if p in got and got[p]["n"] and len(held[p][0]) > 1 else None for p in pairs]
