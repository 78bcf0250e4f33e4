"""Column choice and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import col_of


def select_features(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Model columns in order, with the label last."""
    wanted = [*features, target] if target else list(features)
    return df.select(*[col_of(c) for c in wanted])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns; names that are absent are fine."""
    return df.drop(*cols)


def normalise_names(df: DataFrame) -> DataFrame:
    """Strip and lowercase the column names; two names that become one are an error."""
    names = [c.strip().lower() for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"names clash after normalising: {clash}")
    return df.toDF(*names)


def coalesce_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Rename ``source`` to ``target`` unless the table already has a ``target``, which then wins."""
    if target in df.columns:
        return df.drop(source)
    return df.withColumnRenamed(source, target)


def exclude_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Remove rows whose value is in the set; rows without a value stay."""
    return df.where(~F.coalesce(col_of(col).isin(*values), F.lit(False)))


def keep_labelled(df: DataFrame, col: str, unknown: str = "UNKNOWN") -> DataFrame:
    """Rows whose label is not the unknown marker; a null label counts as known."""
    return df.where(~col_of(col).eqNullSafe(F.lit(unknown)))


def filter_ranges(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Keep rows whose values are null or inside ``(low, high, inclusive)``.

    ``inclusive`` is one of ``both``, ``low``, ``high``, ``neither``; an end may be None.
    Columns that the table lacks are skipped.
    """
    for name, (low, high, inclusive) in ranges.items():
        if name not in df.columns:
            continue
        c, keep = col_of(name), F.lit(True)
        if low is not None:
            keep = keep & ((c >= low) if inclusive in ("both", "low") else (c > low))
        if high is not None:
            keep = keep & ((c <= high) if inclusive in ("both", "high") else (c < high))
        df = df.where(c.isNull() | keep)
    return df


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns that exist."""
    present = [c for c in subset if c in df.columns]
    return df.dropna(subset=present) if present else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both tables, matched by column name; duplicates stay."""
    return a.unionByName(b)
