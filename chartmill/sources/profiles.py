"""Profiles of versioned tables from stored states, without reading old versions again.

Every version adds rows. Beside it lies its **state**: one small row per column (counts, moments, ends, a sketch of the
distinct values and one of the quantiles) and one per named condition. States of any versions merge into the state of
their union, so the profile of a table that has grown reads the new version once and of the old ones only their states.

Counts, ends and counts of conditions are exact, mean and deviation up to rounding; distinct values and quantiles are
within the sketches' errors (about 1 % of the number of values, and 0.4 % of the rank).
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import col_of
from chartmill.operators.missing import is_missing
from chartmill.sources.tables import table_exists, versions, write_versioned

#: Sizes of the sketches: 2^LEVELS registers for distinct values, about 3 * WIDTH kept values for quantiles.
LEVELS, WIDTH = 14, 800

STATE = T.StructType(
    [T.StructField("version", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("name", T.StringType())]
    + [T.StructField("place", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("n", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("mean", "m2", "least", "most")]
    + [T.StructField(c, T.BinaryType()) for c in ("distinct_values", "quantiles")]
)


def profile_state(df: DataFrame, conditions: Mapping[str, str] | None = None, version: int = 0) -> DataFrame:
    """The state of a table (:data:`STATE`): one row per column and one per condition, from one aggregation.

    ``conditions`` maps names to SQL conditions, whose true rows are counted. ``n`` counts a column's present values
    (NaN is missing) or a condition's true rows. An empty table has a state of zeros; a table of no columns has the
    rows of its conditions alone.
    """
    conditions = dict(conditions or {})
    found, rows = [], F.count("*")
    for i, f in enumerate(df.schema.fields):
        c = F.when(~is_missing(df, f.name), col_of(f.name))
        numeric = isinstance(f.dataType, T.NumericType)
        x = c.cast("double") if numeric else F.lit(None).cast("double")
        distinct = F.xxhash64(c.cast("string") if isinstance(f.dataType, T.MapType) else c)
        found.append(
            F.struct(
                F.lit("column").alias("kind"),
                F.lit(f.name).alias("name"),
                F.lit(i).alias("place"),
                rows.alias("rows"),
                F.count(c).alias("n"),
                F.avg(x).alias("mean"),
                (F.var_pop(x) * F.count(x)).alias("m2"),
                F.min(x).alias("least"),
                F.max(x).alias("most"),
                F.hll_sketch_agg(F.when(c.isNotNull(), distinct), LEVELS).alias("distinct_values"),
                (F.kll_sketch_agg_double(x, WIDTH) if numeric else F.lit(None).cast("binary")).alias("quantiles"),
            )
        )
    for i, (name, rule) in enumerate(conditions.items()):
        none = [F.lit(None).cast(STATE[c].dataType).alias(c) for c in STATE.names[6:]]
        hits = F.count(F.when(F.expr(rule), 1)).alias("n")
        found.append(F.struct(F.lit("condition").alias("kind"), F.lit(name).alias("name"), F.lit(i).alias("place"), rows.alias("rows"), hits, *none))
    # The structs are aggregates of their own columns, so the wide row becomes rows without another shuffle.
    wide = df.agg(*[s.alias(f"_s{i}") for i, s in enumerate(found)])
    long = wide.select(F.explode(F.array(*[F.col(f"_s{i}") for i in range(len(found))])).alias("s"))
    return long.select(F.lit(version).alias("version"), "s.*").select(*[F.col(f.name).cast(f.dataType) for f in STATE.fields])


def _states_folder(base: str, conditions: Mapping[str, str] | None) -> str:
    """States of other conditions or sketch sizes lie in other folders."""
    settings = repr((LEVELS, WIDTH, sorted((conditions or {}).items())))
    return f"{base}/_profiles/{hashlib.md5(settings.encode()).hexdigest()}"


def _store_state(spark: SparkSession, base: str, number: int, conditions: Mapping[str, str] | None) -> None:
    rows = spark.read.parquet(f"{base}/version={number}")
    path = f"{_states_folder(base, conditions)}/version={number}"
    profile_state(rows, conditions, number).coalesce(1).write.mode("overwrite").parquet(path)


def append_version(df: DataFrame, base: str, conditions: Mapping[str, str] | None = None) -> int:
    """Save the rows as the next version, and the state of what was saved; returns the version's number."""
    number = write_versioned(df, base)
    _store_state(df.sparkSession, base, number, conditions)
    return number


def version_states(
    spark: SparkSession, base: str, conditions: Mapping[str, str] | None = None, as_of: int | None = None
) -> DataFrame:
    """Stored states of all finished versions, or of those up to ``as_of``.

    A version without a finished state (the job broke off, or the conditions are new) is read once and its state stored.
    """
    wanted = [v for v in versions(spark, base) if as_of is None or v <= as_of]
    if not wanted:
        raise FileNotFoundError(f"no version under {base}")
    paths = [f"{_states_folder(base, conditions)}/version={v}" for v in wanted]
    for number, path in zip(wanted, paths):
        if not table_exists(spark, path):
            _store_state(spark, base, number, conditions)
    return spark.read.schema(STATE).parquet(*paths)


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column and condition: the state of all versions' rows together (version: the last).

    A version that lacks a column counts as one in which all its values are missing.
    """
    own = Window.partitionBy("kind", "name")
    total = states.groupBy("version").agg(F.max("rows").alias("r")).agg(F.sum("r")).scalar()
    # Deviations are taken from the common mean, so large numbers with a small spread lose nothing.
    mean = F.sum(F.col("mean") * F.col("n")).over(own) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(own)
    placed = states.withColumn("_mean", F.when(F.sum("n").over(own) > 0, mean))
    gap = F.col("mean") - F.col("_mean")
    return placed.groupBy("kind", "name").agg(
        F.max("version").alias("version"),
        F.max_by("place", "version").alias("place"),
        F.first(total).alias("rows"),
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + gap * gap * F.col("n")).alias("m2"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.hll_union_agg("distinct_values", True).alias("distinct_values"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("quantiles"))).alias("quantiles"),
    ).select(*STATE.names)


def profile_of_states(states: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, rows, missing, missing_pct, n_distinct, mean, std, min, p<percent>..., max) of all versions together."""
    merged = merge_states(states).where("kind = 'column'")
    numeric = (F.col("n") > 0) & F.col("mean").isNotNull()
    return merged.select(
        F.col("name").alias("column"),
        "rows",
        (F.col("rows") - F.col("n")).alias("missing"),
        F.try_divide((F.col("rows") - F.col("n")) * F.lit(100.0), F.col("rows")).alias("missing_pct"),
        F.when(F.col("n") > 0, F.hll_sketch_estimate("distinct_values")).otherwise(0).alias("n_distinct"),
        "mean",
        F.sqrt(F.try_divide(F.when(F.col("n") > 1, F.col("m2")), F.col("n") - 1)).alias("std"),
        F.col("least").alias("min"),
        *[
            F.when(numeric, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"p{round(p * 100)}")
            for p in probs
        ],
        F.col("most").alias("max"),
    )


def condition_counts(states: DataFrame) -> DataFrame:
    """(condition, rows, n) of all versions together."""
    merged = merge_states(states).where("kind = 'condition'")
    return merged.select(F.col("name").alias("condition"), "rows", "n")


def cleaning_stats_of_states(raw: DataFrame, cleaned: DataFrame, n_features: int, positive: str, negative: str) -> DataFrame:
    """Rows before and after and the balance of the target, as ``profiling.cleaning_stats`` gives them, from states.

    ``positive`` and ``negative`` name conditions of the cleaned table.
    """
    raw_rows = merge_states(raw).agg(F.max("rows").alias("rows")).scalar()
    counts = condition_counts(cleaned).agg(
        F.max("rows").alias("cleaned_rows"),
        F.max(F.when(F.col("condition") == positive, F.col("n"))).alias("positives"),
        F.max(F.when(F.col("condition") == negative, F.col("n"))).alias("negatives"),
    )
    rate = F.bround(F.try_divide(F.col("positives") * F.lit(100.0), F.col("cleaned_rows")), 1)
    return counts.select(
        raw_rows.alias("raw_rows"),
        "cleaned_rows",
        (raw_rows - F.col("cleaned_rows")).alias("removed_rows"),
        F.lit(n_features).alias("features"),
        "positives",
        "negatives",
        rate.alias("rate_pct"),
    )


def cleaning_summary_of_states(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing values per column of two tables side by side, as ``missing.cleaning_summary`` gives them, from states."""

    def side(states: DataFrame, tag: str) -> DataFrame:
        merged = merge_states(states).where("kind = 'column'")
        n_columns = merged.agg(F.count("*").cast("int")).scalar()
        return merged.select(
            F.col("name").alias("column"),
            F.col("rows").alias(f"rows_{tag}"),
            (F.col("rows") - F.col("n")).alias(f"missing_{tag}"),
            n_columns.alias(f"columns_{tag}"),
        )

    return side(before, "before").join(side(after, "after"), "column", "full_outer")
