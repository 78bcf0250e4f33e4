"""Grouping of rows with K-Means, measures of a grouping, and reports on its groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill import functions as X
from chartmill.functions import band, col_of
from chartmill.operators.encode import log1p, standardise
from chartmill.operators.lloyd import Fit, fit_many, squared_silhouettes
from chartmill.operators.lookup import attach, literal_table
from chartmill.operators.missing import fill_zero, value_counts_by_column
from chartmill.operators.neighbours import BLOCK_ROWS, block_pairs, cluster_distances
from chartmill.operators.ordered import percentiles_of_counts
from chartmill.operators.profiling import argmax_row, crosstab, group_profile, group_sizes, rank_groups
from chartmill.operators.sampling import sample_rows
from chartmill.operators.stages import written

#: Most centroids that are broadcast: each is a vector.
FEW_VECTORS = 1_000

# Risk tiers as multiples of the overall rate.
TIER_FACTOR = 1.5
TIER_NAMES = ["High", "Elevated", "Low"]


def cluster_features(
    df: DataFrame,
    cols: Sequence[str],
    log_cols: Sequence[str] = (),
    fill: str = "median",
    vector: str | None = "features",
    suffix: str = "_z",
) -> DataFrame:
    """Add filled, log-scaled and standardised copies ``<col>_z`` and, in ``vector``, their vector.

    With medians the source is read twice: once for a table of value counts (written at once) that medians, means and
    deviations follow from, and once for the result.
    """
    scaled = [f"{c}{suffix}" for c in cols]
    if fill != "median":
        out = df.select("*", *[col_of(c).cast("double").alias(z) for c, z in zip(cols, scaled)])
        out = standardise(log1p(fill_zero(out, scaled), [f"{c}{suffix}" for c in log_cols]), scaled, ddof=0)
        return VectorAssembler(inputCols=scaled, outputCol=vector).transform(out) if vector else out
    counts = written(value_counts_by_column(df, cols).select("column", "value", "n"))
    half = percentiles_of_counts(counts.where("value IS NOT NULL"), [0.5], held=True).select("column", F.col("p50").alias("median"))
    logged = F.col("column").isin(list(log_cols))
    # The filled and logged numbers, of all rows with one value at once; one row per column is broadcast.
    placed = counts.join(F.broadcast(half), "column", "left").withColumn("x", F.coalesce("value", "median"))
    placed = placed.withColumn("x", F.when(logged, X.log1p("x")).otherwise(F.col("x")))
    means = placed.groupBy("column").agg((F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n")))).alias("mean"))
    gap = F.col("x") - F.col("mean")
    spread = F.sqrt(F.sum(gap * gap * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n"))))
    found = placed.join(F.broadcast(means), "column").groupBy("column").agg(
        F.first("median").alias("median"), F.first("mean").alias("mean"), spread.alias("spread")
    )
    table = found.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("median", "mean", "spread")))).alias("m")).scalar()
    out = []
    for c, z in zip(cols, scaled):
        s = F.col("_stats")[c]
        x = F.coalesce(F.nanvl(col_of(c).cast("double"), F.lit(None)), s["median"])
        x = X.log1p(x) if c in log_cols else x
        out.append(((x - s["mean"]) / F.when(s["spread"] == 0, 1.0).otherwise(s["spread"])).alias(z))
    rows = df.withColumn("_stats", table).select(*[col_of(c) for c in df.columns], *out)
    return VectorAssembler(inputCols=scaled, outputCol=vector).transform(rows) if vector else rows


def fit_kmeans(
    df: DataFrame, k: int, seeds: Sequence[int] = range(10), max_iter: int = 300, features: str = "features"
) -> KMeansModel:
    """Best of several starts, by the lowest sum of squared distances; all starts share each pass over the rows.

    Vectors are full and of one length.
    """
    if k < 2:
        raise ValueError(f"k is {k}: at least 2 groups")
    with _held_vectors(df, features) as vectors:
        fits = fit_many(vectors, [(k, seed) for seed in seeds], max_iter)
    if not fits:
        raise ValueError("no rows to group")
    return as_model(df.sparkSession, min(fits, key=lambda f: f.inertia).centres, features)


@contextmanager
def _held_vectors(df: DataFrame, features: str) -> Iterator[DataFrame]:
    vectors = df.select(_array(df, features).alias("v")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield vectors
    finally:
        vectors.unpersist()


def as_model(spark: SparkSession, centres: np.ndarray, features: str = "features") -> KMeansModel:
    """The centres as a model that assigns rows: fitted on just these, each of them is its own group."""
    rows = literal_table(spark, [([float(x) for x in c],) for c in centres], "v array<double>")
    only = KMeans(featuresCol=features, k=max(2, len(centres)), initMode="random", maxIter=1, seed=1)
    return only.fit(rows.select(array_to_vector("v").alias(features)))


def kmeans_assign(
    df: DataFrame,
    k: int,
    seeds: Sequence[int] = range(10),
    max_iter: int = 300,
    features: str = "features",
    name: str = "cluster",
) -> DataFrame:
    """Add the cluster number of each row."""
    model = fit_kmeans(df, k, seeds, max_iter, features)
    return model.setPredictionCol(name).transform(df)


def k_scan(
    df: DataFrame,
    key: str,
    ks: Sequence[int] = range(2, 9),
    sample: int | None = None,
    silhouette_sample: int | None = None,
    seeds: Sequence[int] = range(5),
    max_iter: int = 100,
    features: str = "features",
    seed: int = 42,
) -> DataFrame:
    """(k, inertia, silhouette, best): elbow and silhouette scan; the best k has the top silhouette.

    All rows are used, and the silhouette is the linear one of squared distances. ``sample`` scans that many rows instead;
    ``silhouette_sample`` takes the Euclidean silhouette of that many. ``k`` is the number of centres found: fewer than
    asked for where there are fewer different rows. All (k, seed) pairs share each pass over the rows, and so do the
    silhouettes.
    """
    if min(ks) < 2:
        raise ValueError(f"k is {min(ks)}: at least 2 groups")
    rows = df if sample is None else sample_rows(df, sample, key, seed)
    with _held_vectors(rows, features) as vectors:
        best: dict[int, Fit] = {}
        for fit in fit_many(vectors, [(k, s) for k in ks for s in seeds], max_iter):
            if fit.k not in best or fit.inertia < best[fit.k].inertia:
                best[fit.k] = fit
        if silhouette_sample is None:
            scores = squared_silhouettes(vectors, [f.centres for f in best.values()]) if best else []
        else:
            scores = []
            for f in best.values():
                labelled = as_model(df.sparkSession, f.centres, features).setPredictionCol("cluster").transform(rows)
                scores.append(silhouette(labelled, key, features, "cluster", silhouette_sample, seed).first()[0])
    found = [(len(f.centres), f.inertia, score) for f, score in zip(best.values(), scores)]
    table = literal_table(df.sparkSession, found, "k int, inertia double, silhouette double")
    best = argmax_row(table, "silhouette", "k").select("k").scalar()
    return table.withColumn("best", (F.col("k") == best).cast("int"))


# ---------------------------------------------------------------- measures of a given grouping


def _vector(df: DataFrame, name: str) -> Column:
    return array_to_vector(col_of(name)) if isinstance(df.schema[name].dataType, T.ArrayType) else col_of(name)


def _with_own_centroid(df: DataFrame, vec_col: str, cluster_col: str, few: int) -> DataFrame:
    """(cluster, v, c): each row's vector beside the mean vector of its cluster."""
    rows = df.where(col_of(cluster_col).isNotNull()).select(
        col_of(cluster_col).alias("cluster"), _vector(df, vec_col).alias("_v")
    )
    centroids = rows.groupBy("cluster").agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("c"))
    return attach(rows, "cluster", centroids, "cluster", "c", "c", few).select(
        "cluster", vector_to_array("_v").alias("v"), "c"
    )


def _square_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def inertia(df: DataFrame, vec_col: str, cluster_col: str, few: int = FEW_VECTORS) -> DataFrame:
    """Sum of squared distances of the rows to the mean of their own cluster."""
    placed = _with_own_centroid(df, vec_col, cluster_col, few)
    return placed.agg(F.sum(_square_distance(F.col("v"), F.col("c"))).alias("inertia"))


def silhouette(
    df: DataFrame,
    key: str,
    vec_col: str,
    cluster_col: str,
    sample: int | None = None,
    seed: int = 42,
    block_rows: int | None = None,
) -> DataFrame:
    """Mean Euclidean silhouette of all rows, or of a repeatable sample of ``sample`` rows.

    Computed at once, on rows that are held meanwhile. The work grows with the square of the rows
    used, the rows moved with the rows (or the square over ``block_rows``); all of
    :func:`silhouette_squared` grows with the rows. ``key`` must be unique.
    """
    rows = df.where(col_of(cluster_col).isNotNull())
    if sample is not None:
        rows = sample_rows(rows, sample, key, seed)
    rows = rows.select(
        col_of(key).alias("id"), _array(rows, vec_col).alias("vec"), col_of(cluster_col).alias("own")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = cluster_distances(rows, "id", "vec", "own", block_rows)
        sizes = rows.groupBy("own").agg(F.count("*").alias("n"))
        near = attach(totals, "cluster", sizes, "own", "n", "n").join(rows.select("id", "own"), "id")
        mine = F.col("cluster") == F.col("own")
        per_row = near.groupBy("id").agg(
            F.max(F.when(mine, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
            F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"),
        )
        score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
        # A row alone in its cluster counts 0.
        value = per_row.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(score))).first()[0]
    finally:
        rows.unpersist()
    return literal_table(df.sparkSession, [(value,)], "silhouette double")


def _array(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return col_of(name).cast("array<double>")
    return vector_to_array(col_of(name))


def silhouette_squared(df: DataFrame, vec_col: str, cluster_col: str) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, in one pass over the rows."""
    rows = df.where(col_of(cluster_col).isNotNull()).select(
        _vector(df, vec_col).alias("features"), col_of(cluster_col).cast("double").alias("prediction")
    )
    value = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows)
    return literal_table(df.sparkSession, [(value,)], "silhouette_squared double")


def davies_bouldin(df: DataFrame, vec_col: str, cluster_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean over clusters of the worst (scatter_i + scatter_j) / distance of the centroids.

    Compares every cluster with every other, block against block, and hands on the worst of each block.
    """
    placed = _with_own_centroid(df, vec_col, cluster_col, FEW_VECTORS)
    scatter = placed.groupBy("cluster").agg(
        F.avg(F.sqrt(_square_distance(F.col("v"), F.col("c")))).alias("s"), F.first("c").alias("vec")
    )
    scatter = scatter.select(F.col("cluster").alias("id"), "vec", "s").persist(StorageLevel.MEMORY_AND_DISK)

    def worst(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = np.stack(a["vec"].to_numpy()), np.stack(b["vec"].to_numpy())
        found = []
        for i, v in enumerate(mine):
            gap = np.sqrt(((theirs - v) ** 2).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(gap > 0, (a["s"].iloc[i] + b["s"].to_numpy()) / gap, np.nan)
            ratio[b["id"].to_numpy() == a["id"].iloc[i]] = np.nan
            found.append(np.nan if np.isnan(ratio).all() else np.nanmax(ratio))
        return pd.DataFrame({"id": a["id"], "worst": found})

    try:
        others = scatter.select(*[F.col(c).alias(c) for c in scatter.columns])
        blocks = block_pairs(scatter, others, worst, f"id {scatter.schema['id'].dataType.simpleString()}, worst double", block_rows)
        each = blocks.where(~F.isnan("worst")).groupBy("id").agg(F.max("worst").alias("worst"))
        value = each.agg(F.avg("worst")).first()[0]
    finally:
        scatter.unpersist()
    return literal_table(df.sparkSession, [(value,)], "davies_bouldin double")


# ---------------------------------------------------------------- projection


def fit_pca(df: DataFrame, n: int = 2, features: str = "features") -> PCAModel:
    """Principal components of vectors that are already standardised (mean 0)."""
    return PCA(k=n, inputCol=features, outputCol="pca").fit(df)


def pca_project(df: DataFrame, n: int = 2, features: str = "features", name: str = "pc") -> DataFrame:
    """Add ``pc1``.. and the explained share of variance of each, ``pc1_variance``.."""
    model = fit_pca(df, n, features)
    shares = [float(x) for x in model.explainedVariance]
    projected = model.transform(df).withColumn("_pc", vector_to_array("pca"))
    return projected.select(
        *[col_of(c) for c in df.columns],
        *[F.col("_pc")[i].alias(f"{name}{i + 1}") for i in range(n)],
        *[F.lit(shares[i]).alias(f"{name}{i + 1}_variance") for i in range(n)],
    )


def project_centroids(kmeans: KMeansModel, pca: PCAModel, df: DataFrame) -> DataFrame:
    """(cluster, pc1, pc2, ...): the cluster centres under the same projection."""
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(kmeans.clusterCenters())]
    table = literal_table(df.sparkSession, centres, "cluster int, centre array<double>")
    table = table.withColumn(pca.getInputCol(), array_to_vector("centre"))
    projected = pca.transform(table).withColumn("_pc", vector_to_array("pca"))
    return projected.select("cluster", *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(pca.getK())])


# ---------------------------------------------------------------- reports


def cluster_report(df: DataFrame, cluster_col: str, target: str) -> DataFrame:
    """Size, rate, share of all rows, rank by rate and risk tier of each cluster."""
    sizes = rank_groups(group_sizes(df, cluster_col, target), cluster_col)
    base = df.agg((F.avg(col_of(target)) * 100).alias("r")).scalar()
    tier = band("rate_pct", [base * TIER_FACTOR, base], TIER_NAMES)
    return sizes.withColumn("risk_tier", tier).orderBy("rank")


def cluster_profile(df: DataFrame, cluster_col: str, features: Sequence[str]) -> DataFrame:
    return group_profile(df, cluster_col, features)


def cluster_composition(df: DataFrame, cluster_col: str, label: str, levels: Sequence) -> DataFrame:
    return crosstab(df, cluster_col, label, levels)


def rate_spread(report: DataFrame) -> DataFrame:
    """Distance between the highest and the lowest rate of a report's groups."""
    return report.agg((F.max("rate_pct") - F.min("rate_pct")).alias("rate_spread"))
