"""Euclidean silhouette with a proven error, without comparing all pairs.

The rows of a cluster are gathered in cells by their nearest pivot. A cell keeps its count and moments up to the fourth of
its rows around the pivot. From these follow, for any row x, mean and variance of the *squared* distances to
the cell's rows, and so bounds of the mean distance: with mean m and variance v of z >= 0,

    sqrt(m) * (1 - v / (2 m^2))  <=  mean of sqrt(z)  <=  sqrt(m),

and never less than the distance to the cell's mean (in a row's own cell, both without the row itself). Sums over a cluster's cells bound a row's mean distance to it, and these
bound its silhouette. Cells that leave the most room are split, by pivots drawn from their own rows, until the mean
error is as small as asked for. Each round is two passes over the rows; no row meets another.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.operators.metric_index import matrix
from chartmill.workers import ship

#: Most numbers that all cells hold together, and rows whose bounds are held together.
NUMBERS = 4_000_000
TOGETHER = 2_048
#: Pivots drawn from a cell that is split.
SPLIT = 4


@dataclass(frozen=True)
class Cells:
    """Cells with their cluster, pivot and moments of the rows around it."""

    number: np.ndarray
    cluster: np.ndarray
    pivot: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    covariance: np.ndarray
    skew: np.ndarray
    spread: np.ndarray

    def totals(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(least, likely, largest) sum of distances from each row of ``x`` to the rows of each cell.

        ``home`` is a row's own cell (-1: none); there the row itself is taken out of the moments.
        """
        least, likely, largest = (np.empty((len(x), len(self.n))) for _ in range(3))
        for c in range(len(self.n)):
            e, own = x - self.pivot[c], home == c
            m = np.maximum((e * e).sum(axis=1) - 2 * e @ self.mean[c] + self.square[c], 0.0)
            v = np.maximum(4 * ((e @ self.covariance[c]) * e).sum(axis=1) - 4 * e @ self.skew[c] + self.spread[c], 0.0)
            # Without the row, whose own distance is 0: the same sums over one row less.
            n = np.where(own, self.n[c] - 1, self.n[c])
            share = np.divide(self.n[c], n, out=np.zeros(len(x)), where=n > 0)
            v = np.maximum(share * (v + m * m) - (share * m) ** 2, 0.0)
            m = share * m
            gap = share[:, None] * (e - self.mean[c])
            off = np.divide(v, m * m, out=np.zeros(len(x)), where=m > 0)
            top = np.sqrt(m)
            low = np.minimum(np.maximum(top * (1 - off / 2), np.sqrt((gap * gap).sum(axis=1))), top)
            largest[:, c], least[:, c] = n * top, n * low
            likely[:, c] = n * np.clip(top * (1 - off / 8), low, top)
        return least, likely, largest


def _place(x: np.ndarray, own: np.ndarray, pivots: dict[int, np.ndarray], first: dict[int, int]) -> np.ndarray:
    """The cell of each row: among its cluster's pivots the nearest."""
    cell = np.empty(len(x), np.int64)
    for c in np.unique(own):
        at, mine = np.flatnonzero(own == c), pivots[int(c)]
        for s in range(0, len(at), TOGETHER):
            some = at[s : s + TOGETHER]
            cell[some] = first[int(c)] + ((mine * mine).sum(axis=1) - 2 * x[some] @ mine.T).argmin(axis=1)
    return cell


def silhouette_within(df: DataFrame, vec_col: str, cluster_col: str, error: float = 0.01) -> DataFrame:
    """(silhouette, error): mean Euclidean silhouette of all rows, and a proven bound of how far off it is.

    ``vec_col`` holds arrays of numbers, full and of one length; rows without a cluster take no part. The error is at
    most ``error`` unless that would take more cells than fit in bounded memory (:data:`NUMBERS`); then it is what
    they give. Clusters are so few that their pivots fit as well. Without rows, or with one cluster, both are null.
    """
    spark = df.sparkSession
    ship(spark)
    known = df.where(F.col(f"`{cluster_col}`").isNotNull())
    names = [r[0] for r in known.select(F.col(f"`{cluster_col}`")).distinct().orderBy(F.col(f"`{cluster_col}`")).collect()]
    if len(names) < 2:
        return spark.createDataFrame([(None, None)], "silhouette double, error double")
    numbers = spark.createDataFrame(list(enumerate(names)), f"own int, _name {df.schema[cluster_col].dataType.simpleString()}")
    rows = known.join(F.broadcast(numbers), known[f"`{cluster_col}`"] == F.col("_name")).select(
        "own", F.col(f"`{vec_col}`").cast("array<double>").alias("v")
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        drawn = rows.groupBy("own").agg(F.min_by("v", F.xxhash64("v")).alias("v")).collect()
        pivots = {r["own"]: np.array([r["v"]]) for r in drawn}
        dims = len(drawn[0]["v"])
        while True:
            cells = _moments(rows, pivots, dims)
            value, bound, room = _score(rows, pivots, cells, len(names))
            many = len(cells.n)
            # The cells that leave more room than most share the next pivots.
            loose = np.flatnonzero(room > 0.5 * room.sum() / many)
            if bound <= error or not len(loose) or (many + SPLIT * len(loose)) * (dims * dims + 2 * dims + 3) > NUMBERS:
                break
            grown = _split(rows, pivots, set(cells.number[loose].tolist()))
            if sum(map(len, grown.values())) == many:
                break
            pivots = grown
    finally:
        rows.unpersist()
    return spark.createDataFrame([(value, bound)], "silhouette double, error double")


def _numbered(pivots: dict[int, np.ndarray]) -> dict[int, int]:
    """The number of each cluster's first cell."""
    first, at = {}, 0
    for c in sorted(pivots):
        first[c], at = at, at + len(pivots[c])
    return first


def _moments(rows: DataFrame, pivots: dict[int, np.ndarray], dims: int) -> Cells:
    first = _numbered(pivots)
    pivot = np.concatenate([pivots[c] for c in sorted(pivots)])
    cluster = np.concatenate([np.full(len(pivots[c]), c) for c in sorted(pivots)])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            if not len(b):
                continue
            x = matrix(b.column(1))
            cell = _place(x, b.column(0).to_numpy(), pivots, first)
            for c in np.unique(cell):
                u = x[cell == c] - pivot[c]
                z = (u * u).sum(axis=1)
                new = np.concatenate([[len(u), z.sum(), (z * z).sum()], u.sum(axis=0), z @ u, (u.T @ u).ravel()])
                held[int(c)] = held[int(c)] + new if int(c) in held else new
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["cell", "s"])

    sums = rows.mapInArrow(add, "cell int, s array<double>").groupBy("cell").agg(Summarizer.sum(array_to_vector("s")).alias("s")).collect()
    total = np.zeros((len(pivot), dims * dims + 2 * dims + 3))
    for r in sums:
        total[r["cell"]] = r["s"].toArray()
    used = np.flatnonzero(total[:, 0] > 0.5)
    total, n = total[used], np.round(total[used, 0])
    per = total / n[:, None]
    mean, square = per[:, 3 : 3 + dims], per[:, 1]
    second = per[:, 3 + 2 * dims :].reshape(-1, dims, dims)
    return Cells(
        used,
        cluster[used],
        pivot[used],
        n,
        mean,
        square,
        second - mean[:, :, None] * mean[:, None, :],
        per[:, 3 + dims : 3 + 2 * dims] - mean * square[:, None],
        per[:, 2] - square * square,
    )


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.maximum(a, b)
    return np.divide(b - a, most, out=np.zeros(len(a)), where=most > 0)


def bounded_scores(cells: Cells, clusters: int, x: np.ndarray, own: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(likely silhouette, its largest error, room that each cell leaves) of some rows."""
    member = np.zeros((len(cells.n), clusters))
    member[np.arange(len(cells.n)), cells.cluster] = 1.0
    size = cells.n @ member
    line, found = np.arange(len(x)), []
    least, likely, largest = cells.totals(x, home)
    for d in (least, likely, largest):
        to = d @ member
        a = to[line, own] / np.maximum(size[own] - 1, 1)
        to = to / size
        to[line, own] = np.inf
        found.append((a, to.min(axis=1)))
    (a0, b0), (a1, b1), (a2, b2) = found
    alone = size[own] <= 1
    s = np.where(alone, 0.0, _ratio(a1, b1))
    off = np.where(alone, 0.0, np.maximum(_ratio(a0, b2) - s, s - _ratio(a2, b0)))
    return s, off, (largest - least).sum(axis=0) / size[cells.cluster]


def _score(rows: DataFrame, pivots: dict[int, np.ndarray], cells: Cells, clusters: int) -> tuple[float, float, np.ndarray]:
    many, first = len(cells.n), _numbered(pivots)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 + many)
        for b in batches:
            if not len(b):
                continue
            x, own = matrix(b.column(1)), b.column(0).to_numpy()
            home = np.searchsorted(cells.number, _place(x, own, pivots, first))
            for s in range(0, len(x), TOGETHER):
                part = slice(s, s + TOGETHER)
                value, off, room = bounded_scores(cells, clusters, x[part], own[part], home[part])
                total += np.concatenate([[len(value), value.sum(), off.sum()], room])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    total = rows.mapInArrow(score, "s array<double>").agg(Summarizer.sum(array_to_vector("s")).alias("s")).first()["s"].toArray()
    return float(total[1] / total[0]), float(total[2] / total[0]), total[3:]


def _split(rows: DataFrame, pivots: dict[int, np.ndarray], loose: set[int]) -> dict[int, np.ndarray]:
    """Some rows of the loose cells become pivots too."""
    first = _numbered(pivots)

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                cell = _place(matrix(b.column(1)), b.column(0).to_numpy(), pivots, first)
                kept = pa.array(np.isin(cell, list(loose)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell, pa.int32()), b.column(1)], names=["own", "cell", "v"]).filter(kept)

    told = rows.mapInArrow(tell, "own int, cell int, v array<double>")
    picks = [F.min_by("v", F.xxhash64("v", F.lit(i))).alias(f"p{i}") for i in range(SPLIT)]
    grown = {c: list(map(tuple, p)) for c, p in pivots.items()}
    for r in told.groupBy("own", "cell").agg(*picks).collect():
        grown[r["own"]] += [tuple(r[f"p{i}"]) for i in range(SPLIT)]
    return {c: np.array(list(dict.fromkeys(p))) for c, p in grown.items()}
