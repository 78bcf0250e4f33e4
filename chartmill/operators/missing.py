"""Profiling and filling of missing values. NaN in a floating column counts as missing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import band, col_of, flag, nullify, to_number
from chartmill.operators.ordered import percentile_row, percentiles_of_counts, percentiles_row
from chartmill.operators.stages import written

# Severity bands of a missing percentage, from the highest.
SEVERITY_CUTS = [30.0, 5.0]
SEVERITY_NAMES = ["red", "orange", "yellow"]


def is_missing(df: DataFrame, name: str) -> Column:
    c = col_of(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _melt(row: DataFrame, names: Sequence[str], values: dict[str, list[str]]) -> DataFrame:
    """Turn the one row of a wide aggregate into one row per name."""
    entries = [
        F.struct(F.lit(n).alias("column"), *[col_of(cols[i]).alias(v) for v, cols in values.items()])
        for i, n in enumerate(names)
    ]
    fixed = [c for c in row.columns if not any(c in cols for cols in values.values())]
    return row.select(*fixed, F.explode(F.array(*entries)).alias("_e")).select(*fixed, "_e.*")


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct) for every column, from one pass."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.when(is_missing(df, c), 1)).alias(f"_m{i}") for i, c in enumerate(names)],
    )
    long = _melt(counted, names, {"missing_count": [f"_m{i}" for i in range(len(names))]})
    return long.select(
        "column",
        "missing_count",
        F.try_divide(F.col("missing_count") * F.lit(100.0), F.col("_rows")).alias("missing_pct"),
    )


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table: (missing_total, missing_pct, completeness_pct)."""
    names = df.columns
    cells = F.count("*") * F.lit(len(names))
    missing = reduce(lambda a, b: a + b, [F.count(F.when(is_missing(df, c), 1)) for c in names])
    share = F.try_divide(F.col("missing_total") * F.lit(100.0), F.col("_cells"))
    return df.agg(missing.alias("missing_total"), cells.alias("_cells")).select(
        "missing_total", share.alias("missing_pct"), (F.lit(100.0) - share).alias("completeness_pct")
    )


def top_missing(df: DataFrame, n: int = 15) -> DataFrame:
    """The columns with most missing values, worst first, with a severity band."""
    return (
        missing_profile(df)
        .where("missing_count > 0")
        .withColumn("severity", band("missing_pct", SEVERITY_CUTS, SEVERITY_NAMES, inclusive=False))
        .orderBy(F.desc("missing_pct"), "column")
        .limit(n)
    )


def nullify_tokens(df: DataFrame, tokens: Iterable[str] = ("nan", "")) -> DataFrame:
    """Null for text cells that equal one of the tokens, in all text columns."""
    tokens = list(tokens)
    return df.select(
        *[
            nullify(f.name, tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else col_of(f.name)
            for f in df.schema.fields
        ]
    )


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls of each named column with its value; absent columns are skipped."""
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def to_numeric(
    df: DataFrame, cols: Sequence[str], kind: str = "double", default: float | None = None
) -> DataFrame:
    """Coerce columns to numbers; what is no number becomes null or the default."""
    done = {c: number_of(df, c, kind, default).alias(c) for c in cols if c in df.columns}
    return df.select(*[done.get(c, col_of(c)) for c in df.columns])


def number_of(df: DataFrame, name: str, kind: str = "double", default: float | None = None) -> Column:
    """:func:`~chartmill.functions.to_number` of a column, without the detour where it is numeric already."""
    if not isinstance(df.schema[name].dataType, T.NumericType):
        return to_number(name, kind, default)
    value = F.when(~is_missing(df, name), col_of(name)).try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def value_counts_by_column(df: DataFrame, values: Sequence[str] = (), sums: Sequence[str] = (), levels: Sequence[str] = ()) -> DataFrame:
    """One table, from one scan, that means, order statistics and most frequent values all follow from.

    (column, value, v0, v1, ..., n, total): for each column of ``values`` its different numbers (null: missing) and their
    row counts; for each of ``sums`` one row with the count and the sum; for each of ``levels`` its different values, in
    the field of their type (see :func:`level_fields`). Equal values are merged before they are shuffled.
    """
    fields = level_fields(df, levels)

    def number(c: str) -> Column:
        return F.nanvl(col_of(c).cast("double"), F.lit(None))

    def entry(c: str, **given: Column) -> Column:
        kinds = {"value": "double", "x": "double", **{f: kind for kind, f in fields.items()}}
        return F.struct(F.lit(c).alias("column"), *[given.get(f, F.lit(None)).cast(kind).alias(f) for f, kind in kinds.items()])

    entries = [entry(c, value=number(c)) for c in values] + [entry(c, x=number(c)) for c in sums]
    entries += [entry(c, **{fields[df.schema[c].dataType.simpleString()]: col_of(c)}) for c in levels]
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    known = F.lit(False)
    for f in ("x", *fields.values()):
        known = known | F.col(f).isNotNull()
    long = long.where(known | F.col("column").isin(list(values)))
    return long.groupBy("column", "value", *fields.values()).agg(F.count("*").alias("n"), F.sum("x").alias("total"))


def level_fields(df: DataFrame, levels: Sequence[str]) -> dict[str, str]:
    """The field that holds values of each type."""
    kinds = dict.fromkeys(df.schema[c].dataType.simpleString() for c in levels)
    return {kind: f"v{i}" for i, kind in enumerate(kinds)}


def _per_column(counts: DataFrame, df: DataFrame, sums: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """One row with the mean of each column of ``sums`` and the most frequent value of each of ``levels``."""
    fields = level_fields(df, levels)
    often = [F.min_by(f, F.struct(-F.col("n"), F.col(f))).alias(f) for f in fields.values()]
    found = counts.groupBy("column").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("mean"), *often)
    home = {c: "mean" for c in sums} | {c: fields[df.schema[c].dataType.simpleString()] for c in levels}
    return found.agg(*[F.max(F.when(F.col("column") == c, F.col(f))).alias(c) for c, f in home.items()])


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of each column, from one scan; the smallest of those tied."""
    return _per_column(value_counts_by_column(df, levels=cols), df, [], cols)


def impute(df: DataFrame, plan: Mapping[str, object], accuracy: int | None = None) -> DataFrame:
    """Fill columns by strategy: ``'mean'``, ``'median'``, ``'mode'`` or ``('constant', value)``.

    Each statistic is a one-row subquery, so the table itself is only projected, never joined. Where there are exact
    medians, all statistics come from one table of value counts, which is written (at once): the source is read for it
    and for the result, no further time. ``accuracy`` takes approximate medians instead.
    """
    chosen: dict[str, list[str]] = {}
    for c, how in plan.items():
        kind = how if isinstance(how, str) else how[0]
        if kind not in ("mean", "median", "mode", "constant"):
            raise ValueError(f"unknown strategy {how!r} for {c}")
        chosen.setdefault(kind, []).append(c)

    means, medians, often = (chosen.get(k, []) for k in ("mean", "median", "mode"))
    exact = [] if accuracy is not None else medians
    sources = {}
    if means or often or exact:
        counts = value_counts_by_column(df, exact, means, often)
        if exact:
            counts = written(counts)
            values = counts.where(F.col("column").isin(exact) & F.col("value").isNotNull()).select("column", "value", "n")
            sources["median"] = percentiles_row(percentiles_of_counts(values, [0.5], held=True), exact, 0.5)
        if means or often:
            sources["mean"] = sources["mode"] = _per_column(counts, df, means, often)
    if medians and not exact:
        sources["median"] = percentile_row(df, medians, 0.5, accuracy)
    # Each subquery stands once in the plan; the projection above it reads its fields.
    home = {kind: "_median" if kind == "median" else "_column" for kind in sources}
    rows = df.withColumns({home[kind]: s.select(F.struct("*").alias("v")).scalar() for kind, s in sources.items()})
    found = {kind: F.col(name) for kind, name in home.items()}

    out = []
    for c in df.columns:
        how = plan.get(c)
        kind = how if how is None or isinstance(how, str) else how[0]
        if kind is None:
            out.append(col_of(c))
        elif kind == "constant":
            out.append(F.coalesce(col_of(c), F.lit(how[1])).alias(c))
        elif kind == "mode":
            out.append(F.coalesce(col_of(c), found["mode"][c]).alias(c))
        else:
            value = col_of(c).cast("double")
            out.append(F.coalesce(F.nanvl(value, F.lit(None)), found[kind][c]).alias(c))
    return rows.select(*out)


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute(df, {c: "mean" for c in cols})


def fill_median(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    return impute(df, {c: "median" for c in cols}, accuracy)


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute(df, {c: "mode" for c in cols})


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing values per column of two tables side by side, with their row and column counts."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        counted = df.agg(
            F.count("*").alias(f"rows_{tag}"),
            *[F.count(F.when(is_missing(df, c), 1)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
        )
        long = _melt(counted, df.columns, {f"missing_{tag}": [f"_m{i}" for i in range(len(df.columns))]})
        return long.withColumn(f"columns_{tag}", F.lit(len(df.columns)))

    return side(before, "before").join(side(after, "after"), "column", "full_outer")


def dirty_stats(
    df: DataFrame,
    key: str,
    excluded: tuple[str, Iterable],
    invalid: tuple[str, str],
) -> DataFrame:
    """Defects of a raw table in one row.

    ``excluded`` is (column, codes) of rows to be removed, ``invalid`` (column, value) of a category
    that should not occur. Surplus rows repeat an earlier ``key``.
    """
    names = df.columns
    missing = [F.count(F.when(is_missing(df, c), 1)) for c in names]
    shares = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("n")) for i, c in enumerate(names)]
    )
    percents = F.transform(
        F.filter(shares, lambda s: s["n"] > 0),
        lambda s: F.struct(
            s["column"].alias("column"),
            F.bround(s["n"] * F.lit(100.0) / F.col("total_rows"), 1).alias("pct"),
        ),
    )
    total = reduce(lambda a, b: a + b, [F.col(f"_m{i}") for i in range(len(names))])
    counted = df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(col_of(key)).alias("_keys"),
        F.max(flag(col_of(key).isNull())).alias("_null_key"),
        F.sum(flag(col_of(excluded[0]).isin(*excluded[1]))).alias("excluded_rows"),
        F.sum(flag(col_of(invalid[0]) == F.lit(invalid[1]))).alias("invalid_rows"),
        *[m.alias(f"_m{i}") for i, m in enumerate(missing)],
    )
    return counted.select(
        "total_rows",
        F.lit(len(names)).alias("total_cols"),
        F.bround(F.try_divide(total * F.lit(100.0), F.col("total_rows") * len(names)), 1).alias("total_missing_pct"),
        F.map_from_entries(percents).alias("missing_by_col"),
        F.coalesce(F.col("excluded_rows"), F.lit(0)).cast("bigint").alias("excluded_rows"),
        (F.col("total_rows") - F.col("_keys") - F.coalesce(F.col("_null_key"), F.lit(0)))
        .cast("bigint")
        .alias("surplus_rows"),
        F.coalesce(F.col("invalid_rows"), F.lit(0)).cast("bigint").alias("invalid_rows"),
    )
