"""Sums over the rows of a table that are taken in numpy, task by task, and put together before they reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.functions import col_of
from chartmill.workers import ship

#: Numbers of a task's result that are put together at once, so that no task holds the results of all others.
SLICE = 8192

#: Rows of a block in numpy.
TILE = 2048


def labelled(df: DataFrame, features: str, label: str) -> DataFrame:
    """(x array<double>, y double) of the rows with a label, held, in parts of a tile or more: one per core, or as many as there are.

    A small file is one part however many cores there are.
    """
    y = col_of(label).cast("double")
    rows = df.select(vector_to_array(col_of(features)).alias("x"), y.alias("y")).where(F.col("y").isNotNull())
    return spread(rows, rows.count()).persist(StorageLevel.MEMORY_AND_DISK)


def spread(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in parts of a tile or more: one per core, or as many as there are."""
    least = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, n // TILE))
    parts = rows.rdd.getNumPartitions()
    # What is few is merged by a shuffle too, as a part may hold all rows.
    return rows.repartition(least) if parts < least or n // TILE < parts else rows


def vectors(column: pa.Array) -> np.ndarray:
    """Vectors of the same length, one per row."""
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of :func:`labelled` in blocks of bounded size."""
    for b in batches:
        x, y = vectors(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
        for s in range(0, len(x), TILE):
            yield x[s : s + TILE], y[s : s + TILE]


def reduced(rows: DataFrame, partial: Callable[[Iterable[pa.RecordBatch]], np.ndarray], how: np.ufunc = np.add) -> np.ndarray:
    """What ``partial`` tells of the rows of each task (numbers, always as many), put together by ``how``."""
    ship(rows.sparkSession)

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.ascontiguousarray(partial(batches), dtype=float)
        starts = range(0, len(found), SLICE)
        cut = [found[s : s + SLICE].tobytes() for s in starts]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], names=["slice", "numbers"])

    def merge(t: pa.Table) -> pa.Table:
        total = how.reduce([np.frombuffer(b) for b in t.column("numbers").to_pylist()])
        return pa.table([t.column("slice")[:1], [total.tobytes()]], names=["slice", "numbers"])

    kind = "slice int, numbers binary"
    parts = rows.mapInArrow(own, kind).groupBy("slice").applyInArrow(merge, kind).collect()
    return np.concatenate([np.frombuffer(r["numbers"]) for r in sorted(parts, key=lambda r: r["slice"])])
