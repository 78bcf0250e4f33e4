"""Centroid clustering by scalar lookup tables.

Vectors become whole numbers ``floor(scale * x)``. In each round, for every dimension and every whole number that occurs
in it, the squared differences to all centroids are tabulated; a vector's distances are then gathers from these tables
and their sums, without a multiplication per row. Tables are made per Arrow batch, from the numbers that occur in
it, so their size is bounded by the batch, whatever the range of the numbers.

A round is one pass: tasks hand on a count and a sum per centroid, which Spark adds up; only centroids reach the driver.
All numbers are whole, so the result does not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import map_arrow, ship
from chartmill.llm.integer_vectors import as_lists, floored_means, group_sums, integers, vector_column

#: Rows whose distances are held together.
TOGETHER = 4_096


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers, ascending, and the place of each row's number among them."""
    low, high = int(column.min()), int(column.max())
    if high - low >= 4 * len(column) + 1_024:
        return np.unique(column, return_inverse=True)
    there = np.zeros(high - low + 1, bool)
    there[column - low] = True
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[column - low]


def nearest_by_tables(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each point's nearest centroid (ties: the smaller), and its squared distance."""
    own, least = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for s in range(0, len(points), TOGETHER):
        some = points[s : s + TOGETHER]
        distance = np.zeros((len(some), len(centroids)), np.int64)
        for d in range(points.shape[1]):
            numbers, place = occurring(some[:, d])
            table = (numbers[:, None] - centroids[:, d]) ** 2
            distance += table[place]
        own[s : s + len(some)] = nearest = distance.argmin(axis=1)
        least[s : s + len(some)] = distance[np.arange(len(some)), nearest]
    return own, least


@dataclass(frozen=True)
class Centroids:
    """Whole-number centroids; a vector's components are ``floor(scale * x)``."""

    points: np.ndarray
    scale: int

    @property
    def dims(self) -> int:
        return self.points.shape[1]

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components, as decimals joined by commas."""
        return [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in self.points.tolist()]


def fit_centroids(
    df: DataFrame,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    dims: int = 64,
    seed: str = "1:",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> Centroids | None:
    """Centroids of all vectors that take part (see :func:`assign`); None if there is none.

    They start as the ``k`` vectors (all, if fewer) whose SHA-256 of seed and id is smallest, in that order; ids that
    are null come last, and rows of one id go by their vectors. A centroid that no vector is nearest to stays. Each
    round reads ``df`` again: hand in a written table, not a long plan.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector_column(df, vec_col).alias("v"))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, points = integers(b.column(1), dims, scale)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), as_lists(points)], names=["id", "v"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("v", T.ArrayType(T.LongType()))])
    drawn = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = rows.mapInArrow(whole, schema).orderBy(drawn.asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return None
    found = Centroids(np.array([r["v"] for r in first], np.int64), scale)
    for _ in range(rounds):
        moved = found.points.copy()
        for (c,), mean in floored_means(_sums(rows.select("v"), found), ["centroid"], dims).items():
            moved[c] = mean
        if (moved == found.points).all():
            break  # further rounds would change nothing
        found = Centroids(moved, scale)
    return found


def _sums(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """(centroid, n, s) of each task: count and sums of the vectors nearest to it."""
    k, dims = centroids.points.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            _, points = integers(b.column(0), dims, centroids.scale)
            times, sums = group_sums(nearest_by_tables(points, centroids.points)[0], points, k)
            n += times
            s += sums
        used = np.flatnonzero(n)
        arrays = [pa.array(used, pa.int32()), pa.array(n[used]), as_lists(s[used])]
        yield pa.RecordBatch.from_arrays(arrays, names=["centroid", "n", "s"])

    return vectors.mapInArrow(add, "centroid int, n long, s array<long>")


def assign(df: DataFrame, centroids: Centroids, vec_col: str = "embedding") -> DataFrame:
    """The rows of ``df`` that take part, with ``cluster`` (int, ties to the smaller) and ``distance`` (long, squared);
    they replace columns of these names.

    Vectors that are null, of another length than the centroids, or hold a null or a number that is not finite take
    no part, nor do components so large that squared distances leave 64 bits (``integer_vectors.largest``). Rows
    with a null id and repeated rows count each. An empty table stays empty.
    """
    carry = [c for c in df.columns if c not in ("cluster", "distance")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for b in batches:
            at, points = integers(b.column(len(carry)), centroids.dims, centroids.scale)
            own, distance = nearest_by_tables(points, centroids.points)
            yield [*b.take(pa.array(at)).columns[: len(carry)], pa.array(own, pa.int32()), pa.array(distance)]

    return map_arrow(df, carry, [vector_column(df, vec_col)], run, {"cluster": T.IntegerType(), "distance": T.LongType()})
