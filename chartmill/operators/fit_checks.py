"""Proofs that a fitted model is what its training rows ask for, computed over all rows.

A penalised logistic regression is at its only optimum where, for each term, the mean of ``probability x term`` plus the
penalty's pull equals the mean of ``label x term``. A regression tree's split is right where no other cut of the rows takes
more of the target's variance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.functions import col_of
from chartmill.operators.lookup import literal_table
from chartmill.operators.ordered import running_totals
from chartmill.operators.stages import written


def logistic_optimality(model: PipelineModel, df: DataFrame, label: str, weight: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """(term, coefficient, fitted, observed, gradient) of a logistic model with a squared penalty, its last stage.

    ``df`` holds the training rows. ``observed`` is the weighted mean of label x term; ``fitted`` that of probability x
    term, plus the penalty's pull on the coefficient; ``gradient`` is their difference, 0 at the optimum. The first
    row is the constant term, whose observed value is the weighted share of class 1. One aggregation, without Python.
    """
    last = model.stages[-1]
    if not isinstance(last, LogisticRegressionModel) or last.getElasticNetParam() != 0.0:
        raise ValueError("not a logistic regression with a squared penalty")
    scored = model.transform(df)
    w = F.lit(1.0) if weight is None else col_of(weight).cast("double")
    p, y = vector_to_array("probability")[1], (col_of(label) == 1).cast("double")
    terms = scored.select(F.col(last.getFeaturesCol()).alias("t"), w.alias("w"), (w * p).alias("wp"), (w * y).alias("wy"))
    row = terms.agg(
        F.sum("w").alias("w"),
        F.sum("wp").alias("wp"),
        F.sum("wy").alias("wy"),
        Summarizer.mean(F.col("t"), F.col("wp")).alias("fitted"),
        Summarizer.mean(F.col("t"), F.col("wy")).alias("observed"),
        Summarizer.variance(F.col("t"), F.col("w")).alias("variance"),
    ).first()
    beta, pull = last.coefficients.toArray(), last.getRegParam()
    # The penalty counts coefficients of standardised terms, so it pulls by the variance; Spark can also leave that out.
    size = row["variance"].toArray() if last.getStandardization() else 1.0
    fitted = row["fitted"].toArray() * row["wp"] / row["w"] + pull * size * beta
    observed = row["observed"].toArray() * row["wy"] / row["w"]
    names = list(names) or [f"term {i}" for i in range(len(beta))]
    found = [("constant", float(last.intercept), row["wp"] / row["w"], row["wy"] / row["w"])]
    found += [(n, *map(float, values)) for n, *values in zip(names, beta, fitted, observed)]
    table = literal_table(df.sparkSession, found, "term string, coefficient double, fitted double, observed double")
    return table.withColumn("gradient", F.col("fitted") - F.col("observed"))


def split_gains(df: DataFrame, features: Sequence[str], target: str, weight: str | None = None, least_rows: int = 1) -> DataFrame:
    """(feature, threshold, rows_left, gain): variance of the target that each cut of a column takes away.

    A cut lies midway between two neighbouring values of the column; rows up to it go left. ``gain`` is the weighted
    variance before minus that within the sides, weighted by their share. Cuts that leave fewer than ``least_rows`` on
    a side are left out. Rows are merged per value first, and values are put in order slice by slice, so neither a
    frequent value nor a column with many values meets in one task. Rows with a missing value or target are skipped.
    """
    w = F.lit(1.0) if weight is None else col_of(weight).cast("double")
    long = (
        df.select(w.alias("w"), col_of(target).cast("double").alias("r"), *[col_of(f).cast("double").alias(f) for f in features])
        .unpivot(["w", "r"], list(features), "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("r").isNotNull())
    )
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("r")).alias("s"))
    ranked = running_totals(written(counts), "value", ["n", "w", "s"], ["feature"], few_groups=True, beside=["value"], held=True)
    left, both = F.col("cum_w"), F.col("all_w")
    right = both - left
    rest = F.col("all_s") - F.col("cum_s")
    gain = (F.col("cum_s") * F.col("cum_s") / left + F.try_divide(rest * rest, right) - F.col("all_s") * F.col("all_s") / both) / both
    kept = (F.col("cum_n") >= least_rows) & (F.col("all_n") - F.col("cum_n") >= least_rows)
    return (
        ranked.where(kept & F.col("next_value").isNotNull())
        .select("feature", ((F.col("value") + F.col("next_value")) / 2).alias("threshold"), F.col("cum_n").alias("rows_left"), gain.alias("gain"))
    )


def root_check(model: PipelineModel, df: DataFrame, features: Sequence[str], target: str, weight: str | None = None) -> DataFrame:
    """(feature, threshold, gain, best_gain) of the first tree's root, against all cuts of :func:`split_gains`."""
    root = model.stages[-1].trees[0]._call_java("rootNode")
    split = root.split()
    feature, threshold = features[split.featureIndex()], split.threshold()
    gains = split_gains(df, features, target, weight, model.stages[-1].getMinInstancesPerNode()).withColumn("best_gain", F.lit(None).cast("double"))
    best = gains.agg(F.max("gain")).scalar()
    own = gains.where((F.col("feature") == feature) & (F.abs(F.col("threshold") - threshold) < 1e-9))
    return own.select("feature", "threshold", "gain", best.alias("best_gain"))
