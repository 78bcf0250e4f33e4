"""Finding and removing duplicate rows.

Nulls equal nulls. Every step merges copies inside the map tasks before it shuffles, so a group
that holds a large part of the table does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.functions import col_of

_CHUNK = 100_000


def _order(order_by: str | Sequence, last: bool = False) -> list[Column]:
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    turn = (lambda c: col_of(c).desc_nulls_first()) if last else (lambda c: col_of(c).asc_nulls_last())
    return [turn(c) for c in order_by]


def _expand(df: DataFrame, copies: str) -> DataFrame:
    """One row per copy. Large counts are laid out over several tasks before they unfold."""
    chunk, step = F.lit(_CHUNK), F.col("_chunk")
    return (
        df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, chunk.cast("bigint"))))
        .repartition("_chunk", *[col_of(c) for c in df.columns])
        .withColumn("_copy", F.explode(F.sequence(step, F.least(step + chunk, F.col(copies)) - 1)))
        .drop("_chunk", copies)
    )


def _key_hash(cols: Sequence[str]) -> list[Column]:
    """128 bits that tell a key; nulls count as values."""
    parts = [x for c in cols for x in (col_of(c), col_of(c).isNull())]
    return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("_h2")]


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None, sort: bool = True) -> DataFrame:
    """All members of duplicate groups with ``group_size``, sorted by all columns.

    With a ``subset``, keys are counted by a 128-bit hash, taken as the key; rows move once, to meet the counts of
    repeated keys. That join shuffles both sides, so the adaptive engine splits a key that holds much of the table.
    """
    names = df.columns
    if subset is None or set(subset) == set(names):
        rows = df.groupBy(*[col_of(c) for c in names]).agg(F.count("*").alias("_copies"))
        out = _expand(rows.where("_copies > 1").withColumn("group_size", F.col("_copies")), "_copies")
    else:
        keyed = df.select("*", *_key_hash(subset))
        sizes = df.select(*_key_hash(subset)).groupBy("_h1", "_h2").agg(F.count("*").alias("group_size"))
        # As expressions of the keys, the sizes count as not yet partitioned by them.
        own = [F.bitwise_not(F.bitwise_not(F.col(c))).alias(f"_of{c}") for c in ("_h1", "_h2")]
        sizes = sizes.where("group_size > 1").select(*own, "group_size")
        met = keyed.join(sizes, (F.col("_h1") == F.col("_of_h1")) & (F.col("_h2") == F.col("_of_h2")))
        out = met.select(*[col_of(c) for c in names], "group_size", F.monotonically_increasing_id().alias("_copy"))
    if sort:
        # The copy number parts equal rows, so that range partitioning can split them too.
        out = out.orderBy(*[col_of(c) for c in names], "_copy")
    return out.drop("_copy")


def drop_duplicate_rows(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str | bool = "first",
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first or last row per group, or with ``keep=False`` only rows without a twin.

    With a ``subset``, first and last are told by ``order_by``, which must then be given.
    """
    whole = subset is None
    keys = list(df.columns if whole else subset)
    if keep is False:
        return _without_twin(df, keys)
    if whole:
        return df.dropDuplicates()
    if order_by is None:
        raise ValueError("a table has no row order: say with order_by which row is first")
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    return _one_per_key(df, keys, _order(order_by, last=keep == "last"))


def _without_twin(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    single = (
        df.groupBy(*[col_of(c) for c in keys])
        .agg(F.count("*").alias("_n"), *[F.first(col_of(c)).alias(c) for c in rest])
        .where("_n = 1")
    )
    return single.select(*[col_of(c) for c in df.columns])


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark keeps one row per key in each map task before the exchange (WindowGroupLimit).
    window = Window.partitionBy(*[col_of(c) for c in keys]).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """The earliest row of each key; rows without a key form one group."""
    return _one_per_key(df, [key] if isinstance(key, str) else list(key), _order(order_by))


def count_surplus(df: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat the key of an earlier row: (rows, groups, surplus)."""
    keys = list(df.columns) if key is None else [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*[col_of(c) for c in keys])
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("groups"))
        .withColumn("surplus", F.col("rows") - F.col("groups"))
    )
