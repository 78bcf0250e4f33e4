"""Encoding and scaling of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill import functions as X
from chartmill.functions import KEEP, col_of


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """One projection that swaps the named columns in place."""
    return df.select(*[new[c].alias(c) if c in new else col_of(c) for c in df.columns])


def canonical_case(
    df: DataFrame,
    cols: Sequence[str],
    case: str | None = "upper",
    strip: bool = False,
    null_text: str | None = None,
) -> DataFrame:
    return _replace(df, {c: X.canonical(c, case, strip, null_text) for c in cols if c in df.columns})


def map_values(df: DataFrame, col: str, mapping: Mapping, default=KEEP, name: str | None = None) -> DataFrame:
    """Recode one column, in place or under a new name. See :func:`chartmill.functions.recode`."""
    return df.withColumn(name or col, X.recode(col, mapping, default))


def ordinal_encode(
    df: DataFrame, cols: Sequence[str], mapping: Mapping, default: int = 0, suffix: str = "_enc"
) -> DataFrame:
    """Add ``<col><suffix>`` for many columns that share one mapping."""
    return df.select("*", *[X.recode(c, mapping, default).alias(f"{c}{suffix}") for c in cols])


def one_hot(df: DataFrame, col: str, levels: Sequence, prefix: str | None = None) -> DataFrame:
    """Add an indicator column per listed level."""
    return df.select("*", *X.one_hot(col, levels, f"{col}_" if prefix is None else prefix))


def log1p(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _replace(df, {c: X.log1p(c) for c in cols if c in df.columns})


def moments(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> Column:
    """Mean and spread of columns as a one-row subquery: fields ``m<i>`` and ``s<i>`` (0 -> 1)."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    row = df.agg(
        *[F.avg(col_of(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[spread(col_of(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    fields = [F.col(f"m{i}") for i in range(len(cols))]
    fields += [F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")).alias(f"s{i}") for i in range(len(cols))]
    return row.select(F.struct(*fields).alias("v")).scalar()


def standardise(df: DataFrame, cols: Sequence[str], ddof: int = 0, suffix: str = "") -> DataFrame:
    """z-scores. ``ddof=0`` is the population scale of a scaler, 1 the sample scale; no spread -> 0."""
    at = F.col("_moments")
    scaled = {c: (col_of(c) - at[f"m{i}"]) / at[f"s{i}"] for i, c in enumerate(cols)}
    # The subquery stands once in the plan; the projection above it reads its fields.
    rows = df.withColumn("_moments", moments(df, cols, ddof))
    if suffix:
        return rows.select(*[col_of(c) for c in df.columns], *[v.alias(f"{c}{suffix}") for c, v in scaled.items()])
    return rows.select(*[scaled[c].alias(c) if c in scaled else col_of(c) for c in df.columns])


def interaction_names(cols: Sequence[str]) -> list[str]:
    return [f"{a}*{b}" for a, b in combinations(cols, 2)]


def pairwise_interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add the product of every pair of columns, squares left out."""
    return df.select("*", *[(col_of(a) * col_of(b)).alias(f"{a}*{b}") for a, b in combinations(cols, 2)])
