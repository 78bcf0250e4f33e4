"""Running totals and exact order statistics without sorting a table in one task.

Both need an order over all distinct values. The values are cut into slices at sampled edges, the
slices are totalled (a bounded table), and only inside a slice does a window run over the values
themselves. Equal values are merged before any of this, so a value that fills a third of the table
is one row here, and a dense stretch of values gets as many slices as it has values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartmill.functions import col_of
from chartmill.operators.stages import written


def slice_count(spark: SparkSession, least: int = 1024) -> int:
    """Slices that keep all tasks busy: a power of two, four per shuffle partition or more."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, 1 << (wanted - 1).bit_length())


def _edges(rows: DataFrame, order: Sequence[str], slices: int) -> Column:
    """Sorted sample of ``slices - 1`` keys as a one-row subquery.

    The sample is the keys with the smallest hashes: a uniform pick that comes out the same each
    time it is computed, also after a lost executor.
    """
    keys = [col_of(c) for c in order]
    sample = rows.select(*order).orderBy(F.xxhash64(*keys), *keys).limit(slices - 1)
    return sample.agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("edges")).scalar()


def _add_slice(rows: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """Add ``_slice``, the number of edges <= the row's key, by a binary search in generated code."""
    key = F.struct(*[col_of(c) for c in order])
    rows = rows.withColumns({"_edges": _edges(rows, order, slices), "_key": key})
    at, steps, step = F.lit(0), [], slices // 2
    while step:
        beyond = F.get("_edges", at + (step - 1)) <= F.col("_key")
        steps.append((at + F.when(beyond, step).otherwise(0)).alias(f"_at{step}"))
        at, step = F.col(f"_at{step}"), step // 2
    kept = [c for c in rows.columns if c not in ("_edges", "_key")]
    return rows.select("*", *steps).select(*[col_of(c) for c in kept], at.alias("_slice"))


def in_slices(rows: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add ``_slice``: rows in the order of ``order``, cut into ranges with about as many rows each."""
    return _add_slice(rows, order, slices or slice_count(rows.sparkSession))


def _shared(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows under a condition that always holds and reads every other column.

    The three uses of the rows below need different columns. Without this each would be planned as
    an aggregation of its own; with it all read one exchange.
    """
    others = [col_of(c).cast("double") for c in rows.columns if c not in keys]
    return rows.where(F.greatest(F.lit(0.0), *others) >= 0.0)


def _same(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> Column:
    on = left["_slice"] == right["_r__slice"]
    return reduce(lambda a, c: a & left[f"`{c}`"].eqNullSafe(right[f"`_r_{c}`"]), groups, on)


def running_totals(
    rows: DataFrame,
    value: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    slices: int | None = None,
    only: Column | None = None,
    few_groups: bool | None = None,
    beside: Sequence[str] = (),
    held: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` (running sum in value order, inclusive) and ``all_<m>`` (group total).

    For columns ``beside`` it also adds ``prev_<c>`` and ``next_<c>``, theirs in the row before and after (null at an end).
    Each slice carries its first and last row to its neighbours, past slices without rows of the group.

    ``rows`` holds one row per (groups, value), and numbers beside these. They are read three times (edges, slice totals, sums):
    callers whose rows come from a whole table write them first (``stages.written``) and say so by ``held``; other rows stay part
    of one plan, whose uses share an exchange. ``only`` limits the output to the slices that meet a
    condition on ``before_<m>``, ``slice_<m>`` and ``all_<m>``, which are known before any sort.
    The number of slices follows the number of shuffle partitions. Without groups, or with ``few_groups``, the slice totals are few rows and travel to the values.
    """
    slices = slices or slice_count(rows.sparkSession)
    if slices & (slices - 1):
        raise ValueError("slices must be a power of two")
    rows = _add_slice(rows if held else _shared(rows, [*groups, value]), [*groups, value], slices)
    at = [*groups, "_slice"]

    by_slice = F.desc("_slice") if descending else F.asc("_slice")
    whole = Window.partitionBy(*[col_of(c) for c in groups])
    earlier = whole.orderBy(by_slice).rowsBetween(Window.unboundedPreceding, -1)
    edge = F.struct(*[col_of(c).alias(c) for c in beside]) if beside else None
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    ends = [f(edge, col_of(value)).alias(name) for f, name in ((first, "_first"), (last, "_last"))] if beside else []
    totals = rows.groupBy(*[col_of(c) for c in at]).agg(*[F.sum(col_of(m)).alias(m) for m in measures], *ends)
    offsets = totals.select(
        *[col_of(c).alias(f"_r_{c}") for c in at],
        *[F.coalesce(F.sum(col_of(m)).over(earlier), F.lit(0)).alias(f"before_{m}") for m in measures],
        *[col_of(m).alias(f"slice_{m}") for m in measures],
        *[F.sum(col_of(m)).over(whole).alias(f"all_{m}") for m in measures],
        *[f(end).over(whole.orderBy(by_slice)).alias(name) for f, end, name in ((F.lag, "_last", "_prev"), (F.lead, "_first", "_next")) if beside],
    )
    if only is not None:
        offsets = offsets.where(only)
    if not groups if few_groups is None else few_groups:
        offsets = F.broadcast(offsets)  # at most slices + groups rows

    by_value = col_of(value).desc() if descending else col_of(value).asc()
    inside = (
        Window.partitionBy(*[col_of(c) for c in at])
        .orderBy(by_value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = Window.partitionBy(*[col_of(c) for c in at]).orderBy(by_value)
    near = {"prev": F.coalesce(F.lag(edge).over(ordered), "_prev"), "next": F.coalesce(F.lead(edge).over(ordered), "_next")} if beside else {}
    return rows.join(offsets, _same(rows, offsets, groups)).select(
        *[col_of(c) for c in rows.columns if c != "_slice"],
        *[side.getField(c).alias(f"{name}_{c}") for name, side in near.items() for c in beside],
        *[(F.sum(col_of(m)).over(inside) + col_of(f"before_{m}")).alias(f"cum_{m}") for m in measures],
        *[col_of(f"all_{m}") for m in measures],
    )


def percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Interpolated percentiles of numeric columns: (by..., column, n, p<percent>...).

    Exact unless ``accuracy`` is given, which switches to the bounded-memory approximation. The exact form reads the source
    once, when it is called, into a table of value counts. Nulls and NaN are skipped.
    """
    names = [percent_name(p) for p in probs]
    long = (
        df.select(*[col_of(c) for c in by], *[col_of(c).cast("double").alias(c) for c in cols])
        .unpivot(list(by), list(cols), "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    groups = [*by, "column"]
    keys = [col_of(c) for c in groups]
    if accuracy is not None:
        rough = F.percentile_approx("value", [float(p) for p in probs], accuracy)
        return (
            long.groupBy(*keys)
            .agg(F.count("*").alias("n"), rough.alias("found"))
            .select(*keys, "n", *[F.col("found")[i].alias(name) for i, name in enumerate(names)])
        )
    counts = written(long.groupBy(*keys, "value").agg(F.count("*").alias("n")))
    return percentiles_of_counts(counts, probs, by, held=True)


def percentiles_of_counts(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = (), held: bool = False) -> DataFrame:
    """Exact percentiles from a table (by..., column, value, n) with one row per value: (by..., column, n, p<percent>...).

    ``held`` as in :func:`running_totals`.
    """
    names = [percent_name(p) for p in probs]
    groups = [*by, "column"]
    keys = [col_of(c) for c in groups]
    places = [F.lit(float(p)) * (F.col("all_n") - 1) for p in probs]
    ends = [(F.floor(place), F.ceil(place)) for place in places]
    start, stop = F.col("before_n"), F.col("before_n") + F.col("slice_n")
    wanted = reduce(lambda a, b: a | b, [(start <= r) & (r < stop) for lo_hi in ends for r in lo_hi])
    ranked = running_totals(counts, "value", ["n"], groups, only=wanted, few_groups=not by, held=held)
    picks = []
    for place, lo_hi, name in zip(places, ends, names):
        for end, rank in zip(("lo", "hi"), lo_hi):
            here = (F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank)
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"_{end}_{name}"))
        picks.append((F.max(place) - F.floor(F.max(place))).alias(f"_part_{name}"))
    found = ranked.groupBy(*keys).agg(F.max("all_n").alias("n"), *picks)
    return found.select(
        *keys,
        "n",
        *[
            (F.col(f"_lo_{n}") + F.col(f"_part_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
            for n in names
        ],
    )


def percent_name(p: float) -> str:
    text = f"{p * 100:.6f}".rstrip("0").rstrip(".")
    return "p" + text.replace(".", "_")


def percentile_row(df: DataFrame, cols: Sequence[str], p: float, accuracy: int | None = None) -> DataFrame:
    """One row with the percentile of each column under the column's own name."""
    return percentiles_row(percentiles(df, cols, [p], accuracy=accuracy), cols, p)


def percentiles_row(long: DataFrame, cols: Sequence[str], p: float) -> DataFrame:
    """The same from one row per column."""
    name = percent_name(p)
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col(name))).alias(c) for c in cols])


def rank_cut(share: float, n: Column) -> Column:
    """How many rows make up the share, rounded half up."""
    return F.floor(n * F.lit(share) + F.lit(0.5)).cast("bigint")


def split_points(shares: Sequence[float]) -> list[float]:
    """Running sums of shares that add up to 1."""
    if not math.isclose(sum(shares), 1.0, abs_tol=1e-9) or min(shares) <= 0:
        raise ValueError("shares must be positive and add up to 1")
    points, at = [], 0.0
    for s in shares:
        at += s
        points.append(at)
    points[-1] = 1.0
    return points
