"""Vectors as whole numbers, in tasks: rows that take part, exact sums per group, floored means."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def vector_column(df: DataFrame, name: str) -> Column:
    """The vectors as they are, where their components are floating numbers; else as doubles."""
    kind = df.schema[name].dataType
    plain = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    return F.col(f"`{name}`") if plain else F.col(f"`{name}`").cast("array<double>")


def largest(dims: int) -> int:
    """Components beyond this could take a squared distance, or four times one, out of 64 bits."""
    return math.isqrt((1 << 60) // dims) // 2


def lengths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length of each vector that is present, full and finite (-1 for others), and where its components begin."""
    n = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    bad = ~np.isfinite(values.to_numpy(zero_copy_only=False).astype(np.float64))
    if values.null_count:
        bad |= values.is_null().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(n, 0))
    wrong = np.concatenate([[0], np.cumsum(bad)])
    starts = ends - np.maximum(n, 0)
    return np.where(wrong[ends] > wrong[starts], -1, n), starts


def integers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and ``floor(scale * x)`` of their components."""
    n, starts = lengths(column)
    rows = np.flatnonzero(n == dims)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.floor(scale * values[starts[rows, None] + np.arange(dims)])
    fits = (np.abs(found) <= largest(dims)).all(axis=1)
    return rows[fits], found[fits].astype(np.int64)


def as_lists(points: np.ndarray) -> pa.Array:
    """Rows of a matrix as a column of lists."""
    n, width = points.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(points.ravel()))


def usual_length(df: DataFrame, vec: Column, multiple: int = 1) -> int:
    """The commonest length of valid vectors, of those that ``multiple`` divides (ties: the larger); 0 without any."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            for length, times in zip(*np.unique(lengths(b.column(0))[0], return_counts=True)):
                if length > 0 and length % multiple == 0:
                    seen[int(length)] = seen.get(int(length), 0) + int(times)
        yield pa.RecordBatch.from_pydict({"n": pa.array(list(seen), pa.int64()), "times": pa.array(list(seen.values()), pa.int64())})

    counted = df.select(vec.alias("v")).mapInArrow(count, "n long, times long").groupBy("n").agg(F.sum("times").alias("times"))
    first = counted.orderBy(F.desc("times"), F.desc("n")).first()
    return first["n"] if first else 0


def group_sums(own: np.ndarray, points: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of each group's points."""
    width = points.shape[1]
    at = (own[:, None] * width + np.arange(width)).ravel()
    # Weights are doubles: sums of at most 2**24 of these numbers are exact.
    sums = np.bincount(at, weights=points.ravel(), minlength=groups * width)
    return np.bincount(own, minlength=groups), sums.astype(np.int64).reshape(groups, width)


def floored_means(sums: DataFrame, keys: list[str], width: int) -> dict[tuple[int, ...], np.ndarray]:
    """Exact ``floor(sum / count)`` per key, from rows (keys, ``n``, ``s`` with the sums) of all tasks.

    One row per key reaches the driver; keys come from the caller's bounded set of entries.
    """
    exact = [F.sum(F.get("s", F.lit(j)).cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    found = sums.groupBy(*keys).agg(F.sum("n").alias("n"), *exact).collect()
    return {tuple(r[k] for k in keys): np.array([int(r[f"s{j}"]) // r["n"] for j in range(width)], np.int64) for r in found}
