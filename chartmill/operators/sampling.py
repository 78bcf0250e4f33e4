"""Splits, folds, samples and class weights.

Choices follow a hash of the row key and a seed: the same rows come out on every run and after a
lost executor, and no row has to move. Splitting a part of an earlier split again needs another seed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.functions import col_of
from chartmill.operators.lookup import FEW, attach
from chartmill.operators.ordered import rank_cut, running_totals, split_points

_GRAIN = 1 << 30


def _hash(key: str | Sequence[str], seed: int, use: str) -> Column:
    """Hash of the key. ``use`` keeps a fold, say, independent of the split its rows came from."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.xxhash64(*[col_of(k) for k in keys], F.lit(seed), F.lit(use))


def hash_unit(key: str | Sequence[str], seed: int, use: str) -> Column:
    """Uniform number in [0, 1) told by key, seed and use."""
    return F.pmod(_hash(key, seed, use), F.lit(_GRAIN)) / F.lit(float(_GRAIN))


def _parts(df: DataFrame, label: str, key: str, seed: int, use: str, cuts: Sequence[Column], name: str) -> DataFrame:
    """Add the number of cuts at or before each row in the hash order of its label.

    A cut is a rank, told from ``all_n`` (rows of the label). What is looked up per label is the first hash beyond
    each cut; rows compare their hash with it, and rows with one hash stay together.
    """
    counts = df.select(col_of(label), _hash(key, seed, use).alias("_hash"))
    counts = counts.groupBy(col_of(label), "_hash").agg(F.count("*").alias("n"))
    start, stop = F.col("before_n"), F.col("before_n") + F.col("slice_n")
    wanted = reduce(lambda a, b: a | b, [(start <= c) & (c < stop) for c in cuts])
    ranked = running_totals(counts, "_hash", ["n"], [label], only=wanted)
    beyond = [F.min(F.when(F.col("cum_n") > c, F.col("_hash"))).alias(f"b{i}") for i, c in enumerate(cuts)]
    limits = ranked.groupBy(col_of(label)).agg(*beyond).withColumn("_first", F.array(*[f"b{i}" for i in range(len(cuts))]))
    rows = attach(df, label, limits, label, "_first", "_first")
    own, part = _hash(key, seed, use), F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        # Without a hash beyond the cut, all rows are before it.
        part = F.when(F.coalesce(own < F.col("_first")[i], F.lit(True)), F.lit(i)).otherwise(part)
    return rows.withColumn(name, part).drop("_first")


def stratified_split(
    df: DataFrame,
    label: str,
    shares: Sequence[float],
    key: str,
    seed: int = 42,
    exact: bool = False,
    name: str = "split",
) -> DataFrame:
    """Add an int column with the part (0, 1, ...) each row belongs to.

    By default class shares hold to sampling error and nothing is shuffled. ``exact=True`` makes
    every label's parts come out at the rounded share, for the price of finding each label's cuts in the order of
    hashes; rows do not move for it.
    """
    points = split_points(shares)
    if not exact:
        unit = hash_unit(key, seed, "split")
        part = F.lit(len(points) - 1)
        for i in reversed(range(len(points) - 1)):
            part = F.when(unit < points[i], F.lit(i)).otherwise(part)
        return df.withColumn(name, part)
    return _parts(df, label, key, seed, "split", [rank_cut(p, F.col("all_n")) for p in points[:-1]], name)


def kfold_assign(
    df: DataFrame,
    label: str,
    k: int,
    key: str,
    seed: int = 42,
    exact: bool = False,
    name: str = "fold",
) -> DataFrame:
    """Add an int fold number 0..k-1; with ``exact`` the folds of a label differ by one row at most."""
    if not exact:
        return df.withColumn(name, F.floor(hash_unit(key, seed, "fold") * k).cast("int"))
    n = F.col("all_n")
    cuts = [F.floor(n / k) * i + F.least(F.lit(i), n % k) for i in range(1, k)]
    return _parts(df, label, key, seed, "fold", cuts, name) if cuts else df.withColumn(name, F.lit(0))


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement (all, if there are fewer): those with the smallest hashes.

    The hash at which to stop is found at once from counts; the rows up to it stay where they are. Only of rows that share
    that one hash some are picked in order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    own = _hash(keys, seed, "sample")
    counts = df.select(own.alias("_hash")).groupBy("_hash").agg(F.count("*").alias("n"))
    here = (F.col("before_n") <= n) & (F.lit(n) < F.col("before_n") + F.col("slice_n"))
    ranked = running_totals(counts, "_hash", ["n"], only=here).where(F.col("cum_n") > n)
    stop = ranked.agg(F.min(F.struct("_hash", (F.col("cum_n") - F.col("n")).alias("below"))).alias("s")).first()["s"]
    if stop is None:
        return df
    under, missing = df.where(own < stop["_hash"]), n - stop["below"]
    if not missing:
        return under
    return under.unionAll(df.where(own == stop["_hash"]).orderBy(*[col_of(k) for k in keys]).limit(missing))


#: Places or copies that one array holds at most before they become rows.
_STRETCH = 1 << 16


def _digits(*parts: Column) -> Column:
    """60 bits of a hash that other engines have too, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _numbers(rows: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    """Each row once for each number from ``start`` to before ``end`` (at least one), in arrays of bounded length."""
    steps = rows.withColumns({"_end": end, "_from": F.explode(F.sequence(start, end - 1, F.lit(_STRETCH).cast("long")))})
    upto = F.least(F.col("_from") + _STRETCH, F.col("_end")) - 1
    return steps.withColumn(name, F.explode(F.sequence("_from", upto))).drop("_end", "_from")


def bootstrap(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42, cap: float | None = None) -> DataFrame:
    """Exactly ``n`` rows with replacement, every row as likely each time (none of an empty table); with ``cap``, at most
    ``cap`` times the table, which is counted for it.

    The rows have places in the order of a hash of key and seed, each draw takes the place that a hash of its number
    tells, and draws of one place are counted before they meet the rows. Places are told from running totals, so no task
    sorts the table. Rows alike in all columns are one row with several places.
    """
    n = n if cap is None else min(n, int(cap * df.count()))
    keys = [F.coalesce(col_of(k).cast("string"), F.lit("")) for k in ([key] if isinstance(key, str) else key)]
    row = F.struct(_digits(F.lit(str(seed)), *keys).alias("at"), F.xxhash64(*[col_of(c) for c in df.columns]).alias("of"))
    rows = df.withColumn("_row", row)
    ranked = running_totals(rows.groupBy("_row").agg(F.count("*").alias("n")), "_row", ["n"])
    places = _numbers(ranked.select("_row", "n", "cum_n"), F.col("cum_n") - F.col("n"), F.col("cum_n"), "_place").select("_row", "_place")

    total = F.nullif(df.agg(F.count("*").alias("n")).scalar(), F.lit(0))
    drawn = df.sparkSession.range(n).select(F.pmod(_digits(F.lit(str(seed)), F.lit("draw"), F.col("id").cast("string")), total).alias("_place"))
    drawn = drawn.groupBy("_place").agg(F.count("*").alias("_drawn"))
    copies = places.join(drawn, "_place").groupBy("_row").agg(F.sum("_drawn").alias("_copies"))
    met = rows.dropDuplicates(["_row"]).join(copies, "_row")
    return _numbers(met, F.lit(0).cast("long"), F.col("_copies"), "_copy").select(*[col_of(c) for c in df.columns])


def balanced_weights(df: DataFrame, label: str, name: str = "weight", few: int = FEW) -> DataFrame:
    """Add ``rows / (labels * rows of the label)``; ``few`` as in :func:`~.lookup.attach`."""
    counts = df.where(col_of(label).isNotNull()).groupBy(col_of(label)).agg(F.count("*").alias("_n"))
    whole = counts.agg(F.struct(F.sum("_n").cast("double").alias("n"), F.count("*").alias("k")).alias("v")).scalar()
    at = F.col("_all")
    weights = counts.withColumn("_all", whole).withColumn("_w", at["n"] / (at["k"] * F.col("_n")))
    return attach(df, label, weights, label, "_w", name, few)
