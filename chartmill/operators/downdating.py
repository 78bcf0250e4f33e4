"""Cross-validation of models that have a closed form, from one pass over the rows.

Ridge regression and Gaussian naive Bayes need no more of the rows than counts, sums and cross products per class. These are
taken per fold and class in one aggregation; the training part of a fold is everything minus the fold. So all folds and all
penalties cost one scan, and a second one to score each row with the model that has not seen it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import col_of
from chartmill.operators.metrics import binary_metrics
from chartmill.operators.stages import written
from chartmill.workers import ship

#: Added to variances of naive Bayes, as a share of the largest variance of a column.
SMOOTHING = 1e-9


@dataclass(frozen=True)
class Moments:
    """Count, sums and cross products of rows, shifted by a fixed row so that they keep their digits."""

    n: float
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products)

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def scatter(self) -> np.ndarray:
        """Cross products of the differences from the mean."""
        return self.products - np.outer(self.sums, self.sums) / self.n


@dataclass(frozen=True)
class FoldStatistics:
    """Moments per fold and class, and the row by which they are shifted."""

    features: tuple[str, ...]
    shift: np.ndarray
    parts: dict[tuple[int, int], Moments]

    @property
    def folds(self) -> list[int]:
        return sorted({fold for fold, _ in self.parts})

    def trained(self, without: int | None = None) -> list[Moments]:
        """Moments of class 0 and 1 of all rows but those of a fold: the total minus the fold's own."""
        p = len(self.features)
        none = Moments(0.0, np.zeros(p), np.zeros((p, p)))
        total = [sum((m for (_, c), m in self.parts.items() if c == y), none) for y in (0, 1)]
        return total if without is None else [t - self.parts.get((without, y), none) for y, t in enumerate(total)]


def fold_statistics(df: DataFrame, features: Sequence[str], label: str, fold: str) -> FoldStatistics:
    """Moments per fold and class, in one aggregation. ``label`` is 0 or 1, ``fold`` a whole number.

    Tasks hand on one row per fold and class. Rows with a missing number, label or fold take no part.
    """
    rows = _rows(df, features, label, fold)
    first, p = rows.first(), len(features)
    shift = np.array(first[2:], float) if first else np.zeros(p)
    parts = {}
    # One row per fold and class reaches the driver.
    for r in moment_sums(rows, p, shift).collect():
        s = np.array(r["s"], float)
        parts[r["fold"], r["y"]] = Moments(r["n"], s[:p], s[p:].reshape(p, p))
    return FoldStatistics(tuple(features), shift, parts)


def _rows(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """(fold, y, x0, x1, ...) of the rows that take part."""
    x = [col_of(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    rows = df.select(col_of(fold).cast("int").alias("fold"), col_of(label).cast("int").alias("y"), *x)
    return rows.where(_complete(["fold", "y"], [f"x{i}" for i in range(len(x))]))


def moment_sums(rows: DataFrame, p: int, shift: np.ndarray) -> DataFrame:
    """(fold, y, n, s): ``s`` has the sums and then the cross products of the p columns, less ``shift``."""
    ship(rows.sparkSession)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], Moments] = {}
        for b in batches:
            if not len(b):
                continue
            f, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            values = np.column_stack([b.column(2 + i).to_numpy() for i in range(p)]) - shift
            for key in set(zip(f.tolist(), y.tolist())):
                part = values[(f == key[0]) & (y == key[1])]
                new = Moments(float(len(part)), part.sum(axis=0), part.T @ part)
                seen[key] = seen[key] + new if key in seen else new
        arrays = [
            pa.array([k[0] for k in seen], pa.int32()),
            pa.array([k[1] for k in seen], pa.int32()),
            pa.array([m.n for m in seen.values()], pa.float64()),
            pa.array([np.concatenate([m.sums, m.products.ravel()]) for m in seen.values()], pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["fold", "y", "n", "s"])

    parts = rows.mapInArrow(add, "fold int, y int, n double, s array<double>")
    return parts.groupBy("fold", "y").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"))


def _complete(whole: Sequence[str], numbers: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in whole:
        ok = ok & F.col(c).isNotNull()
    for c in numbers:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return ok


@dataclass(frozen=True)
class Linear:
    """Margin ``x . weights + constant``; class 1 from 0 up."""

    weights: np.ndarray
    constant: float


@dataclass(frozen=True)
class Bell:
    """Gaussian naive Bayes: log prior, means and variances of both classes."""

    log_prior: np.ndarray
    mean: np.ndarray
    variance: np.ndarray


def ridge(stats: FoldStatistics, without: int | None = None, penalty: float = 1.0) -> Linear | None:
    """Least squares on classes -1 and 1 with a penalty on the weights of standardised columns (n - 1 in the deviation).

    None if the training rows lack a class. A constant column gets weight 0.
    """
    low, high = stats.trained(without)
    if not low.n or not high.n:
        return None
    both = low + high
    scatter, mean = both.scatter, both.mean
    spread = np.sqrt(np.maximum(np.diag(scatter), 0.0) / max(both.n - 1, 1.0))
    scale = np.where(spread > 1e-12 * np.sqrt(np.maximum(np.diag(both.products) / both.n, 1e-300)), spread, np.inf)
    towards = (high.sums - low.sums) - mean * (high.n - low.n)
    gram = scatter / np.outer(scale, scale)
    weights = np.linalg.solve(gram + penalty * np.eye(len(mean)), towards / scale) / scale
    return Linear(weights, float((high.n - low.n) / both.n - weights @ (mean + stats.shift)))


def naive_bayes(stats: FoldStatistics, without: int | None = None) -> Bell | None:
    """Gaussian naive Bayes; None if the training rows lack a class."""
    classes = stats.trained(without)
    if not all(c.n for c in classes):
        return None
    n = sum(c.n for c in classes)
    overall = (classes[0] + classes[1]).scatter
    extra = SMOOTHING * float(np.diag(overall).max()) / n
    variance = np.array([np.maximum(np.diag(c.scatter), 0.0) / c.n for c in classes]) + max(extra, 1e-300)
    return Bell(np.log([c.n / n for c in classes]), np.array([c.mean + stats.shift for c in classes]), variance)


def _of_fold(values: dict[int, float], folds: Sequence[int]) -> Column:
    """A number that depends on the row's fold (null where the fold has no model)."""
    table = [F.lit(values.get(f)).cast("double") for f in range(max(folds) + 1)]
    return F.get(F.array(*table), F.col("_fold"))


def margin(models: dict[int, Linear | Bell | None], features: Sequence[Column]) -> Column:
    """Log odds (or linear margin) of a row under its own fold's model, in built-in functions."""
    folds = sorted(models)
    known = {f: m for f, m in models.items() if m is not None}
    if all(isinstance(m, Linear) for m in known.values()):
        total = _of_fold({f: m.constant for f, m in known.items()}, folds)
        for i, x in enumerate(features):
            total = total + x * _of_fold({f: float(m.weights[i]) for f, m in known.items()}, folds)
        return total
    constant = {f: float(m.log_prior[1] - m.log_prior[0] - 0.5 * (np.log(m.variance[1]) - np.log(m.variance[0])).sum()) for f, m in known.items()}
    total = _of_fold(constant, folds)
    for i, x in enumerate(features):
        for sign, y in ((-0.5, 1), (0.5, 0)):
            gap = x - _of_fold({f: float(m.mean[y][i]) for f, m in known.items()}, folds)
            total = total + gap * gap * _of_fold({f: sign / float(m.variance[y][i]) for f, m in known.items()}, folds)
    return total


def cross_validate_closed(
    df: DataFrame, features: Sequence[str], label: str, fold: str, penalties: Sequence[float] = (1.0,), bayes: bool = True
) -> DataFrame:
    """(model, fold, n, accuracy, roc_auc) of ridge classifiers and Gaussian naive Bayes on each held-out fold.

    Folds are whole numbers from 0 (see ``sampling.kfold_assign``). Rows with a missing number, label or fold take no
    part; a fold without whose rows a class is missing has no model and no row here.
    """
    stats = fold_statistics(df, features, label, fold)
    if not stats.parts:
        return df.sparkSession.createDataFrame([], "model string, fold int, n bigint, accuracy double, roc_auc double")
    models: dict[str, dict] = {f"Ridge (penalty={c:g})": {f: ridge(stats, f, c) for f in stats.folds} for c in penalties}
    if bayes:
        models["Gaussian Naive Bayes"] = {f: naive_bayes(stats, f) for f in stats.folds}
    rows = _rows(df, features, label, fold).withColumnsRenamed({"fold": "_fold", "y": "_y"})
    inner = [F.col(f"x{i}") for i in range(len(features))]
    scores = F.array(*[F.struct(F.lit(name).alias("model"), margin(m, inner).alias("m")) for name, m in models.items()])
    scored = rows.select("_fold", "_y", F.explode(scores).alias("s")).select("_fold", "_y", "s.model", "s.m").where(F.col("m").isNotNull())
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))
    # The order of margins, also of those whose chance rounds to 0 or 1.
    held = written(scored.select("model", "_fold", "_y", F.col("m").alias("score"), (chance >= 0.5).cast("int").alias("hit")))
    got = binary_metrics(held, "_y", "score", "hit", by=["model", "_fold"])
    return got.select("model", F.col("_fold").alias("fold"), "n", "accuracy", "roc_auc")
