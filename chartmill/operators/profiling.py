"""Counts, rates, distributions and group profiles.

Results are small tables. Row-level data is reduced by partial aggregates before any exchange, so a
group that holds a large part of the rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.functions import col_of, flag
from chartmill.operators.missing import _melt, is_missing
from chartmill.operators.ordered import in_slices, percentiles, percentiles_of_counts
from chartmill.operators.rows import numeric_columns
from chartmill.operators.stages import written


def _as(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


# ---------------------------------------------------------------- counts per level


def value_counts(df: DataFrame, col: str, sort: str = "count") -> DataFrame:
    """(col, n, share) per non-null level; sorted by falling count or by level."""
    counts = df.where(col_of(col).isNotNull()).groupBy(col_of(col)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    out = counts.withColumn("share", F.col("n") / total)
    return out.orderBy(F.desc("n"), col_of(col)) if sort == "count" else out.orderBy(col_of(col))


def _level_table(df: DataFrame, col: str, levels: Sequence, name: str) -> DataFrame:
    kind = df.schema[col].dataType
    entries = [F.struct(F.lit(i).alias("position"), F.lit(v).cast(kind).alias(name)) for i, v in enumerate(levels)]
    return df.sparkSession.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _on_levels(df: DataFrame, col: str, levels: Sequence, *aggregates: Column) -> DataFrame:
    """Aggregates for each listed level; listed levels without rows come out null."""
    found = (
        df.where(col_of(col).isin(*levels)).groupBy(col_of(col).alias("_level")).agg(*aggregates)
    )  # never more rows than levels, hence small enough to broadcast
    wanted = _level_table(df, col, levels, col)
    return (
        wanted.join(F.broadcast(found), wanted[f"`{col}`"] == found["_level"], "left")
        .drop("_level")
        .orderBy("position")
    )


def value_counts_for(df: DataFrame, col: str, levels: Sequence) -> DataFrame:
    """Counts for a fixed ordered list of levels: (position, col, n), absent -> 0."""
    return _on_levels(df, col, levels, F.count("*").alias("n")).withColumn("n", F.coalesce("n", F.lit(0)))


def compare_value_counts(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Counts of the levels of two tables side by side: (col, n_a, n_b), sorted by level."""
    known = col_of(col).isNotNull()
    left = a.where(known).select(col_of(col), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.where(known).select(col_of(col), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    return (
        left.unionByName(right)
        .groupBy(col_of(col))
        .agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"))
        .orderBy(col_of(col))
    )


def group_rate(df: DataFrame, key: str, target: str, order: Sequence | None = None) -> DataFrame:
    """Mean of a 0/1 target per group, in percent. With ``order`` absent levels have a null rate."""
    rate = (F.avg(col_of(target)) * 100).alias("rate_pct")
    if order is not None:
        return _on_levels(df, key, order, rate)
    return df.where(col_of(key).isNotNull()).groupBy(col_of(key)).agg(rate).orderBy(col_of(key))


def group_rate_count(df: DataFrame, key: str, target: str, asc: bool = True) -> DataFrame:
    """Mean and count of a 0/1 target per group, sorted by the mean, then by group."""
    out = (
        df.where(col_of(key).isNotNull())
        .groupBy(col_of(key))
        .agg(F.avg(col_of(target)).alias("rate"), F.count(col_of(target)).alias("n"))
    )
    return out.orderBy(F.asc("rate") if asc else F.desc("rate"), col_of(key))


def rate_by_level(df: DataFrame, key: str, levels: Sequence, target: str) -> DataFrame:
    """Count and rounded rate for each listed level; levels without rows show 0."""
    found = _on_levels(
        df, key, levels, F.count("*").alias("n"), F.bround(F.avg(col_of(target)) * 100, 1).alias("rate_pct")
    )
    return found.fillna({"n": 0, "rate_pct": 0.0})


def count_distinct(df: DataFrame, col: str, rsd: float | None = None) -> DataFrame:
    """Number of different non-null values; with ``rsd`` an estimate of that relative error."""
    c = col_of(col)
    if rsd is not None:
        n = F.approx_count_distinct(c, rsd)
    elif df.schema[col].dataType.simpleString() in ("string", "binary"):
        # Long values are told apart by 128 bits; the values themselves do not move.
        n = F.count_distinct(F.when(c.isNotNull(), F.xxhash64(c)), F.xxhash64(F.lit(1), c))
    else:
        n = F.count_distinct(c)
    return df.agg(n.alias("n_distinct"))


# ---------------------------------------------------------------- table summaries


def stage_counts(df: DataFrame, key: str, col: str, excluded: Sequence) -> DataFrame:
    """Rows at each cleaning stage, in one row and one aggregation.

    ``raw_deduped`` dedupes the unfiltered table, as the reference chart does; ``final`` is the
    number of keys left after the exclusion.
    """
    per_key = df.groupBy(col_of(key)).agg(
        F.count("*").alias("n"),
        F.sum(flag(col_of(col).isin(*excluded))).alias("out"),
    )
    kept = F.col("n") - F.col("out")
    return per_key.agg(
        F.sum("n").alias("raw"),
        F.sum(kept).alias("after_exclusion"),
        F.count("*").alias("raw_deduped"),
        F.count(F.when(kept > 0, 1)).alias("final"),
    )


def cleaning_stats(raw: DataFrame, cleaned: DataFrame, target: str, n_features: int) -> DataFrame:
    """Rows before and after, and the balance of the target, in one row."""
    raw_rows = raw.agg(F.count("*").alias("n")).scalar()
    after = cleaned.agg(
        F.count("*").alias("cleaned_rows"),
        F.count(F.when(col_of(target) == 1, 1)).alias("positives"),
        F.count(F.when(col_of(target) == 0, 1)).alias("negatives"),
    )
    return after.select(
        raw_rows.alias("raw_rows"),
        "cleaned_rows",
        (raw_rows - F.col("cleaned_rows")).alias("removed_rows"),
        F.lit(n_features).alias("features"),
        "positives",
        "negatives",
        F.bround(F.try_divide(F.col("positives") * F.lit(100.0), F.col("cleaned_rows")), 1).alias("rate_pct"),
    )


def describe(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Type, rows, missing values and, for numeric columns, moments and quartiles: one row per column."""
    names, numeric = df.columns, numeric_columns(df)
    stats = {"missing": lambda c: F.count(F.when(is_missing(df, c), 1))}
    for out, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
        stats[out] = lambda c, fn=fn: (
            fn(F.nanvl(col_of(c).cast("double"), F.lit(None))) if c in numeric else F.lit(None).cast("double")
        )
    wide = {out: [f"_{out}{i}" for i in range(len(names))] for out in stats}
    row = df.agg(
        F.count("*").alias("rows"),
        *[fn(c).alias(wide[out][i]) for out, fn in stats.items() for i, c in enumerate(names)],
    )
    long = _melt(row, names, wide)
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    head = long.withColumn("dtype", F.element_at(kinds, F.col("column"))).withColumn(
        "count", F.col("rows") - F.col("missing")
    )
    if not numeric:
        return head
    quarters = percentiles(df, numeric, accuracy=accuracy).drop("n")
    # At most one row per column of the table.
    return head.join(F.broadcast(quarters), "column", "left").select(
        "column", "dtype", "rows", "missing", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form (x, y, corr); each pair skips the rows where either is null."""
    cols = list(cols) if cols else numeric_columns(df)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    row = df.agg(*[F.corr(col_of(cols[i]), col_of(cols[j])).alias(f"_c{i}_{j}") for i, j in pairs])
    entries = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_c{max(i, j)}_{min(i, j)}").alias("corr"))
        for i, x in enumerate(cols)
        for j, y in enumerate(cols)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# ---------------------------------------------------------------- distributions


def histogram(
    df: DataFrame,
    col: str,
    bins: int | Sequence[float] = 10,
    by: str | None = None,
    density: bool = False,
) -> DataFrame:
    """Counts per bin: ([by], bin, low, high, n[, density]); empty bins show 0.

    ``bins`` is a number of equal bins between the extremes, or a rising list of edges. Bins are
    closed on the left, the last one on both sides. Values outside the edges are not counted.
    """
    c = col_of(col).cast("double")
    rows = df.where(c.isNotNull() & ~F.isnan(c)).select(
        *([col_of(by).alias("_by")] if by else []), c.alias("_v")
    )
    if isinstance(bins, int):
        n_bins = bins
        span = (
            rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
            .select(
                F.struct(
                    F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                    F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
                ).alias("v")
            )
            .scalar()
        )
        rows, found = rows.withColumn("_span", span), span
        span = F.col("_span")
        width = (span["hi"] - span["lo"]) / n_bins

        def edge(i: Column) -> Column:
            return F.when(i == n_bins, span["hi"]).otherwise(span["lo"] + i * width)

        near = F.floor((F.col("_v") - span["lo"]) / width).cast("int")
        near = F.least(F.greatest(near, F.lit(0)), F.lit(n_bins - 1))
        # Division may land one bin off the edges as reported; compare with the edges themselves.
        place = (
            F.when(F.col("_v") < edge(near), near - 1)
            .when((near < n_bins - 1) & (F.col("_v") >= edge(near + 1)), near + 1)
            .otherwise(near)
        )
    else:
        edges = [float(b) for b in bins]
        n_bins = len(edges) - 1
        listed = F.array(*[F.lit(b) for b in edges])

        def edge(i: Column) -> Column:
            return F.get(listed, i)

        below = sum((flag(F.col("_v") >= b) for b in edges[1:-1]), F.lit(0))
        place = F.when((F.col("_v") >= edges[0]) & (F.col("_v") <= edges[-1]), below)

    keys = ["_by"] if by else []
    counts = (
        rows.select(*keys, place.alias("bin")).where("bin is not null").groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    )
    # At most (groups x bins) rows: lay a full grid of bins beside each group.
    per_group = counts.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_found"), F.sum("n").alias("_total")
    )
    if isinstance(bins, int):
        per_group = per_group.withColumn("_span", found)
    grid = per_group.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    n = F.coalesce(F.try_element_at("_found", F.col("bin")), F.lit(0))
    low, high = edge(F.col("bin")), edge(F.col("bin") + 1)
    out = [*([F.col("_by").alias(by)] if by else []), "bin", low.alias("low"), high.alias("high"), n.alias("n")]
    if density:
        out.append(F.try_divide(n.cast("double"), F.col("_total") * (high - low)).alias("density"))
    return grid.select(*out)


def box_stats(
    df: DataFrame, cols: Sequence[str], by: str | None = None, accuracy: int | None = None
) -> DataFrame:
    """Quartiles, whiskers at the most extreme values within 1.5 IQR, and the number of outliers.

    The table is first reduced to its distinct values with counts, which are written (at once). Values lie in range
    slices of each group; whiskers and outliers are taken per slice, and only then meet per group. Most slices lie
    inside the limits or beyond them, which their ends tell; only values of the slices that hold a limit (two
    per group and column) are looked at, joined by slice, so a group with much of the table is spread over many tasks.
    """
    keys = [by] if by else []
    at = [*keys, "column"]
    counts = written(
        df.select(*[col_of(k) for k in keys], *[col_of(c).cast("double").alias(c) for c in cols])
        .unpivot(keys, list(cols), "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*[col_of(k) for k in at], "value")
        .agg(F.count("*").alias("n"))
    )
    probs = (0.25, 0.5, 0.75)
    quarters = percentiles_of_counts(counts, probs, keys, held=True) if accuracy is None else percentiles(df, cols, probs, keys, accuracy)
    reach = (F.col("p75") - F.col("p25")) * 1.5
    limits = quarters.select(
        *[col_of(c).alias(f"_r_{c}") for c in at], "p25", "p50", "p75", F.col("n").alias("all_n"),
        (F.col("p25") - reach).alias("low"), (F.col("p75") + reach).alias("high"),
    )
    if not by:
        limits = F.broadcast(limits)  # one row per column

    def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> list[Column]:
        return [left[f"`{c}`"].eqNullSafe(right[f"`_r_{c}`"]) for c in names]

    rows = in_slices(counts, [*at, "value"])
    totals = rows.groupBy(*[col_of(c) for c in at], "_slice").agg(F.min("value").alias("first"), F.max("value").alias("last"), F.sum("n").alias("n"))
    placed = totals.join(limits, same(totals, limits, at))
    inside = (F.col("first") >= F.col("low")) & (F.col("last") <= F.col("high"))
    beyond = (F.col("last") < F.col("low")) | (F.col("first") > F.col("high"))
    fixed = ["p25", "p50", "p75", "all_n"]
    whole = placed.where(inside | beyond).select(
        *[col_of(c) for c in at], *fixed, F.when(inside, F.col("first")).alias("least"), F.when(inside, F.col("last")).alias("most"), F.when(beyond, F.col("n")).alias("out")
    )
    mixed = placed.where(~(inside | beyond)).select(
        *[col_of(c).alias(f"_r_{c}") for c in at], F.col("_slice").alias("_r__slice"), *fixed, "low", "high"
    )
    if not by:
        mixed = F.broadcast(mixed)  # two rows per column at most
    kept = F.col("value").between(F.col("low"), F.col("high"))
    parts = (
        rows.join(mixed, same(rows, mixed, [*at, "_slice"]))
        .groupBy(*[col_of(c) for c in [*at, "_slice"]], *fixed)
        .agg(
            F.min(F.when(kept, F.col("value"))).alias("least"),
            F.max(F.when(kept, F.col("value"))).alias("most"),
            F.sum(F.when(~kept, F.col("n"))).alias("out"),
        )
        .drop("_slice")
    )
    return (
        whole.unionByName(parts)
        .groupBy(*[col_of(c) for c in at], *fixed)
        .agg(
            # A whisker never ends inside the box.
            F.least(F.min("least"), F.col("p25")).alias("whisker_low"),
            F.greatest(F.max("most"), F.col("p75")).alias("whisker_high"),
            F.coalesce(F.sum("out"), F.lit(0)).alias("outliers"),
        )
        .select(
            *[col_of(c) for c in at],
            F.col("all_n").alias("n"),
            F.col("p25").alias("q1"),
            F.col("p50").alias("median"),
            F.col("p75").alias("q3"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )


def crosstab(df: DataFrame, row: str, col: str, levels: Sequence) -> DataFrame:
    """Counts of the listed levels of ``col`` per level of ``row``, one column per level."""
    known = df.where(col_of(row).isNotNull())
    return (
        known.groupBy(col_of(row))
        .agg(*[F.count(F.when(col_of(col) == F.lit(v), 1)).alias(str(v)) for v in levels])
        .orderBy(col_of(row))
    )


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """The same counts as (row, col, n), for levels that are not known beforehand."""
    known = col_of(row).isNotNull() & col_of(col).isNotNull()
    return df.where(known).groupBy(col_of(row), col_of(col)).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- group profiles


def group_profile(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Mean of each feature per group, and its distance from the overall mean in sample deviations.

    Long form: (key, feature, mean, z). A feature without spread has z 0.
    """
    parts = (
        df.where(col_of(key).isNotNull())
        .groupBy(col_of(key))
        .agg(*[F.avg(col_of(f)).alias(f"_m{i}") for i, f in enumerate(features)])
    )
    overall = (
        df.agg(
            *[F.avg(col_of(f)).alias(f"m{i}") for i, f in enumerate(features)],
            *[F.stddev_samp(col_of(f)).alias(f"s{i}") for i, f in enumerate(features)],
        )
        .select(F.struct("*").alias("v"))
        .scalar()
    )
    entries, at = [], F.col("_overall")
    for i, f in enumerate(features):
        spread = F.when(at[f"s{i}"] == 0, 1.0).otherwise(at[f"s{i}"])
        z = (F.col(f"_m{i}") - at[f"m{i}"]) / spread
        entries.append(F.struct(F.lit(f).alias("feature"), F.col(f"_m{i}").alias("mean"), z.alias("z")))
    rows = parts.withColumn("_overall", overall)
    return rows.select(col_of(key), F.explode(F.array(*entries)).alias("e")).select(col_of(key), "e.*")


def group_sizes(df: DataFrame, key: str, target: str) -> DataFrame:
    """Rows, rate in percent and share of all rows in percent, per group."""
    counts = (
        df.where(col_of(key).isNotNull())
        .groupBy(col_of(key))
        .agg(F.count("*").alias("n"), (F.avg(col_of(target)) * 100).alias("rate_pct"))
    )
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("pct_of_total", F.col("n") * F.lit(100.0) / total)


def group_stats(
    df: DataFrame, key: str, label: str, levels: Sequence, features: Sequence[str]
) -> DataFrame:
    """Size, counts per listed label and rounded feature means of each group."""
    return (
        df.where(col_of(key).isNotNull())
        .groupBy(col_of(key))
        .agg(
            F.count("*").alias("size"),
            *[F.count(F.when(col_of(label) == F.lit(v), 1)).alias(f"n_{v}") for v in levels],
            *[F.bround(F.avg(col_of(f)), 2).alias(f"mean_{f}") for f in features],
        )
    )


# ---------------------------------------------------------------- ranking of small results


def rank_groups(sizes: DataFrame, key: str, rate: str = "rate_pct") -> DataFrame:
    """Number the groups of a report from the highest rate down; ties go by key.

    For tables with one row per group, not for row-level data.
    """
    order = Window.orderBy(col_of(rate).desc_nulls_last(), col_of(key))
    return sizes.withColumn("rank", F.row_number().over(order))


def top_k(df: DataFrame, by: str, k: int, asc: bool = False, tie: Sequence[str] | str = ()) -> DataFrame:
    """First k rows in order of ``by``; each task keeps only its own k best."""
    first = col_of(by).asc_nulls_last() if asc else col_of(by).desc_nulls_last()
    return df.orderBy(first, *[col_of(t) for t in _as(tie)]).limit(k)


def argmax_row(df: DataFrame, by: str, tie: str | None = None) -> DataFrame:
    """The row with the highest value; the smallest ``tie`` value among equals."""
    rows = df.where(col_of(by).isNotNull())
    packed = F.struct(*[col_of(c) for c in df.columns])
    if tie is None:
        best = F.max_by(packed, col_of(by))
    else:
        at_top = rows.agg(F.max(col_of(by)).alias("v")).scalar()
        rows = rows.where(col_of(by) == at_top)
        best = F.min_by(packed, col_of(tie))
    return rows.agg(best.alias("r")).where("r is not null").select("r.*")


def scatter_points(df: DataFrame, x: str, y: str, n: int, key: str, seed: int = 0) -> DataFrame:
    """Up to n (x, y) pairs for a plot, picked repeatably."""
    from chartmill.operators.sampling import sample_rows

    return sample_rows(df, n, key, seed).select(col_of(x), col_of(y))
