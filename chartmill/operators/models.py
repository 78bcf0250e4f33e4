"""Training, scoring and comparison of classifiers on pyspark.ml."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Bucketizer,
    PolynomialExpansion,
    StandardScaler,
    StandardScalerModel,
    UnivariateFeatureSelector,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.functions import col_of, label_case
from chartmill.operators.encode import moments
from chartmill.operators.extra_trees import ExtraTreesClassifier
from chartmill.operators.kernel_svm import RbfSVC
from chartmill.operators.lookup import literal_table
from chartmill.operators.metrics import area_per_score, baseline_metrics, binary_metrics, draw_share
from chartmill.operators.neighbours import label_shares, nearest, vote
from chartmill.operators.sampling import balanced_weights, bootstrap, kfold_assign, stratified_split
from chartmill.operators.stages import written
from chartmill.operators.task_sums import spread


@dataclass(frozen=True)
class BoostConfig:
    """Settings of the boosted trees; the defaults are those of the reference model."""

    trees: int = 500
    step: float = 0.05
    depth: int = 4
    min_leaf: int = 30
    row_share: float = 0.8
    feature_subset: str = "sqrt"
    seed: int = 42


@dataclass(frozen=True)
class Candidate:
    """A named model: how its estimator is built for n training rows, and how it is read out."""

    name: str
    build: Callable[[int], Estimator]
    scale: bool = False
    select: int | None = None
    family: str = "small_data"
    label: str = "label"
    params: Mapping = field(default_factory=dict)


def checkpoint_interval(spark: SparkSession, every: int = 10) -> int:
    """How often tree boosting may cut its lineage: each ``every`` trees where the session has a shared folder for it,
    else never (-1), which the log says. The caller's session is not changed.
    """
    if spark.sparkContext.getCheckpointDir() is not None:
        return every
    logging.getLogger(__name__).warning("no checkpoint folder (spark.checkpoint.dir): boosting keeps its whole lineage")
    return -1


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)


def fit_pipeline(
    df: DataFrame,
    features: Sequence[str],
    estimator: Estimator,
    label: str,
    scale: bool | StandardScalerModel = False,
    select: int | None = None,
) -> PipelineModel:
    """Assemble, optionally scale (also by a scaler that is fitted) and select features, and fit."""
    stages: list = [_assembler(features)]
    at = "features"
    if scale:
        stages.append(_scaler() if scale is True else scale)
        at = "scaled"
    if select is not None:
        chooser = UnivariateFeatureSelector(featuresCol=at, outputCol="selected", labelCol=label)
        chooser.setFeatureType("continuous").setLabelType("categorical")
        chooser.setSelectionMode("numTopFeatures").setSelectionThreshold(min(select, len(features)))
        stages.append(chooser)
        at = "selected"
    stages.append(estimator.copy({estimator.getParam("featuresCol"): at}))
    return Pipeline(stages=stages).fit(df)


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    config: BoostConfig = BoostConfig(),
    balanced: bool = True,
) -> PipelineModel:
    """Boosted trees on balanced weights."""
    rows = df.select(*[col_of(c) for c in features], col_of(label).cast("double").alias(label))
    estimator = GBTClassifier(
        labelCol=label,
        maxIter=config.trees,
        stepSize=config.step,
        maxDepth=config.depth,
        minInstancesPerNode=config.min_leaf,
        subsamplingRate=config.row_share,
        featureSubsetStrategy=config.feature_subset,
        seed=config.seed,
        checkpointInterval=checkpoint_interval(df.sparkSession),
    )
    if balanced:
        rows = balanced_weights(rows, label, "_weight")
        estimator.setWeightCol("_weight")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_pipeline(rows, features, estimator, label)
    finally:
        rows.unpersist()


def model_zoo() -> list[Candidate]:
    """Candidates for small tables that Spark's trainers fit; :func:`whole_zoo` has all.

    C of a penalised model becomes regParam = 1 / (C * rows).
    """

    def logistic(c: float, l1: bool):
        return lambda n: LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=float(l1), maxIter=1000)

    def svm(c: float):
        return lambda n: LinearSVC(regParam=1.0 / (c * n), maxIter=100)

    def tree(depth: int, leaf: int):
        return lambda n: DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, seed=42)

    zoo = [Candidate(f"Linear SVM (C={c})", svm(c), scale=True) for c in (0.01, 0.1, 1.0)]
    zoo += [Candidate(f"Lasso Logistic (C={c})", logistic(c, True), scale=True) for c in (0.01, 0.1)]
    zoo += [
        Candidate("Ridge Logistic (C=0.1)", logistic(0.1, False), scale=True),
        Candidate(
            "Ridge Classifier",
            lambda n: LinearRegression(regParam=1.0 / n, elasticNetParam=0.0, solver="normal"),
            scale=True,
            label="signed",
        ),
        Candidate("Decision Tree (depth=2)", tree(2, 3)),
        Candidate("Decision Tree (depth=3)", tree(3, 2)),
        Candidate("Logistic + Feature Selection", logistic(0.1, False), scale=True, select=5),
        Candidate(
            "Gradient Boosting (regularized)",
            lambda n: GBTClassifier(maxIter=50, maxDepth=2, minInstancesPerNode=5, stepSize=0.1, subsamplingRate=0.8, seed=42),
        ),
        Candidate("Random Forest - Original", lambda n: RandomForestClassifier(numTrees=100, seed=42), family="original"),
        Candidate("Naive Bayes - Original", lambda n: NaiveBayes(modelType="gaussian"), family="original"),
    ]
    return zoo


#: Neighbours of the votes that belong to the comparison.
NEIGHBOURS = (3, 5, 7)


def whole_zoo() -> list[Candidate]:
    """All candidates of the comparison that are fitted: those of Spark's trainers, extra-trees and Gaussian support vectors."""
    return [
        *model_zoo(),
        Candidate(
            "Extra Trees (constrained)", lambda n: ExtraTreesClassifier(trees=50, depth=2, min_leaf=5, min_split=10, seed=42)
        ),
        Candidate("SVM (RBF) - Original", lambda n: RbfSVC(c=1.0), scale=True, family="original"),
    ]


def fit_candidate(
    df: DataFrame, features: Sequence[str], label: str, candidate: Candidate, shared: dict | None = None
) -> PipelineModel:
    """The candidate fitted on the rows; ``shared`` carries their number and their scaler from one candidate to the next."""
    shared = {} if shared is None else shared
    rows = df.withColumns(
        {"_label": col_of(label).cast("double"), "_signed": col_of(label).cast("double") * 2 - 1}
    )
    if "n" not in shared:
        shared["n"] = rows.count()
    if candidate.scale and "scaler" not in shared:
        shared["scaler"] = _scaler().fit(_assembler(features).transform(rows))
    estimator = candidate.build(shared["n"])
    target = "_signed" if candidate.label == "signed" else "_label"
    estimator.setParams(labelCol=target, **candidate.params)
    if isinstance(estimator, GBTClassifier):
        estimator.setCheckpointInterval(checkpoint_interval(df.sparkSession))
    return fit_pipeline(rows, features, estimator, target, candidate.scale and shared["scaler"], candidate.select)


def logistic_interactions(
    df: DataFrame, features: Sequence[str], label: str, c: float = 0.05, max_iter: int = 2000, tol: float = 1e-9
) -> PipelineModel:
    """Balanced logistic regression on standardised columns and all their pairwise products.

    :func:`interaction_terms` names its terms; ``fit_checks.logistic_optimality`` proves the fit.
    """
    # Degree-2 terms come as one block per column: itself, its products with earlier ones, its square.
    terms = [j * (j + 3) // 2 + i for j in range(len(features)) for i in range(j + 1)]
    stages: list = [
        _assembler(features),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        PolynomialExpansion(degree=2, inputCol="scaled", outputCol="expanded"),
        VectorSlicer(inputCol="expanded", outputCol="terms", indices=terms),
    ]
    rows = balanced_weights(df, label, "_weight").withColumn("_label", col_of(label).cast("double"))
    rows = rows.select(*[col_of(f) for f in features], "_label", "_weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages.append(
            LogisticRegression(
                featuresCol="terms",
                labelCol="_label",
                weightCol="_weight",
                regParam=1.0 / (c * rows.count()),
                maxIter=max_iter,
                tol=tol,
            )
        )
        return Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()


def interaction_terms(features: Sequence[str]) -> list[str]:
    """Names of the terms of :func:`logistic_interactions`, in their order: each column, then its products with earlier ones."""
    return [name for j, b in enumerate(features) for name in (b, *[f"{a} x {b}" for a in features[:j]])]


# ---------------------------------------------------------------- scoring


def probability(model: Transformer, scored: DataFrame) -> Column:
    """P(1) of scored rows; a model that gives only a margin gets the logistic of its margin."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in scored.columns:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array("rawPrediction")[1]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("prediction")))


def score(model: Transformer, df: DataFrame, p1: str = "p1", pred: str = "prediction") -> DataFrame:
    """The rows with P(1) and the predicted class; all helper columns are gone."""
    scored = model.transform(df)
    chance = probability(model, scored)
    signed = "probability" not in scored.columns and "rawPrediction" not in scored.columns
    hit = (F.col("prediction") >= 0) if signed else (F.col("prediction") == 1)
    return scored.select(*[col_of(c) for c in df.columns], chance.alias(p1), hit.cast("int").alias(pred))


def score_batch(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Class, both probabilities, their percentages and the reader text for a table of encoded rows."""
    scored = score(model, df)
    return scored.select(
        *[col_of(c) for c in df.columns],
        "prediction",
        (F.lit(1.0) - F.col("p1")).alias("p0"),
        "p1",
        label_case("prediction").alias("label_text"),
        F.bround((F.lit(1.0) - F.col("p1")) * 100, 1).alias("low_risk_pct"),
        F.bround(F.col("p1") * 100, 1).alias("high_risk_pct"),
    )


def soft_vote(df: DataFrame, models: Sequence[PipelineModel], extra: Sequence[str] = ()) -> DataFrame:
    """Mean P(1) of several models, and the class it tells.

    ``extra`` names columns that already hold a P(1), such as a neighbour vote joined to the rows.
    """
    names = []
    out = df
    for i, model in enumerate(models):
        out = score(model, out, f"_p{i}", f"_c{i}").drop(f"_c{i}")
        names.append(f"_p{i}")
    chances = [col_of(n) for n in [*names, *extra]]
    total = chances[0]
    for c in chances[1:]:
        total = total + c
    out = out.withColumn("p1", total / len(chances)).drop(*names)
    return out.withColumn("prediction", (F.col("p1") > 0.5).cast("int"))


# ---------------------------------------------------------------- evaluation


def _fold_rows(df: DataFrame, label: str, k: int, key: str, seed: int, fold: str | None = None) -> DataFrame:
    """The rows with ``_fold``: dealt by the key's hash, or taken from a column of whole numbers from 0."""
    if fold is not None:
        rows = df.withColumn("_fold", col_of(fold).cast("int"))
    else:
        rows = kfold_assign(df, label, k, key, seed, name="_fold")
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def _held_out(rows: DataFrame, fit: Callable[[DataFrame], PipelineModel], label: str, k: int) -> DataFrame:
    """(_fold, label, p1, _pred): each row scored by the model that was trained without its fold."""
    parts = []
    for fold in range(k):
        model = fit(rows.where(F.col("_fold") != fold))
        scored = score(model, rows.where(F.col("_fold") == fold), pred="_pred")
        parts.append(scored.select("_fold", col_of(label), "p1", "_pred"))
    return reduce(DataFrame.unionByName, parts)


def _scored_beside(rows: DataFrame, models: Sequence[Sequence[PipelineModel]], label: str) -> DataFrame:
    """(_fold, label, _p0, _c0, _p1, ...): each row once, scored by all models that were trained without its fold.

    What comes before the models themselves (of :func:`fit_pipeline`) is done once where they share it.
    """
    parts = []
    for fold, own in enumerate(models):
        out, held = rows.where(F.col("_fold") == fold), {}
        for i, model in enumerate(own):
            way: tuple = ()
            for stage in model.stages[:-1]:
                name = stage.getOutputCol()
                way += (tuple(stage.getInputCols()) if isinstance(stage, VectorAssembler) else stage.uid,)
                if held.get(name) != way:
                    out, held[name] = stage.transform(out.drop(name) if name in held else out), way
            out = score(model.stages[-1], out, f"_p{i}", f"_c{i}")
        parts.append(out.select("_fold", col_of(label), *[f"_{c}{i}" for i in range(len(own)) for c in "pc"]))
    return reduce(DataFrame.unionByName, parts)


def _held_out_areas(
    rows: DataFrame, fits: Mapping[str, Callable[[DataFrame, dict], PipelineModel]], label: str, k: int, seed: int
) -> DataFrame:
    """(_name, _fold, accuracy, roc_auc) of several ways to fit; what they share of a fold's training rows is in a dict."""
    counts = {r["_fold"]: r["count"] for r in rows.groupBy("_fold").count().collect() if r["_fold"] is not None}

    def fitted(fold: int) -> list[PipelineModel]:
        train, shared = rows.where(F.col("_fold") != fold), {"n": sum(n for f, n in counts.items() if f != fold)}
        return [fit(train, shared) for fit in fits.values()]

    # Folds side by side, as Spark's own CrossValidator can: a fit is many short jobs, which leave cores idle.
    with ThreadPool(max(1, k)) as pool:
        models = pool.map(inheritable_thread_target(rows.sparkSession)(fitted), range(k))
    names = {name: (f"_p{i}", f"_c{i}") for i, name in enumerate(fits)}
    share = draw_share(sum(counts.values()))
    drawn = _scored_beside(written(rows.sample(share, seed)), models, label) if share else None
    return area_per_score(_scored_beside(rows, models, label), label, names, "_fold", sum(counts.values()), drawn)


def _held_out_votes(
    rows: DataFrame, features: Sequence[str], label: str, key: str, folds: int, ks: Sequence[int]
) -> DataFrame:
    """The same for distance-weighted votes of the k nearest standardised training rows, for each k."""
    # Keys may repeat or be null: rows are told apart by their place in the order of keys, which also decides ties.
    placed = written(rows.orderBy(col_of(key)).withColumn("_row", F.monotonically_increasing_id()))
    parts = []
    for fold in range(folds):
        train, held = placed.where(F.col("_fold") != fold), placed.where(F.col("_fold") == fold)
        scale = Pipeline(stages=[_assembler(features), _scaler()]).fit(train)
        parts.append(nearest(scale.transform(held), scale.transform(train), max(ks), "_row", "scaled", label))
    # Written, so that the neighbours are not searched again for each k.
    near = written(reduce(DataFrame.unionByName, parts))
    truth = placed.select("_fold", col_of(label), "_row")
    votes = []
    for k in ks:
        shares = label_shares(near.where(F.col("rank") <= k)).where(F.col("label") == 1)
        scored = truth.join(shares, truth["_row"] == shares["id"], "left").fillna(0.0, subset=["share"])
        hit = (F.col("share") > 0.5).cast("int")
        votes.append(
            scored.select("_fold", col_of(label), F.col("share").alias("p1"), hit.alias("_pred")).withColumn(
                "_name", F.lit(f"KNN (k={k})")
            )
        )
    return reduce(DataFrame.unionByName, votes)


#: Rows drawn at least to find a column's cuts, as many as Spark's own trees draw.
_CUT_ROWS = 10_000


def _cuts(values: np.ndarray, most: int) -> list[float]:
    """At most ``most - 1`` cuts of a column: between all its values, or where there are more, after even shares of the rows."""
    found, counts = np.unique(values[np.isfinite(values)], return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) < most:
        return between.tolist()
    share = counts.sum() / most
    upto, wanted, cuts = np.cumsum(counts), share, []
    for i, cut in enumerate(between):
        if abs(upto[i] - wanted) < abs(upto[i + 1] - wanted):
            cuts.append(float(cut))
            wanted += share
    return cuts[: most - 1]


def _cuts_of(parts: Sequence[DataFrame], sizes: Sequence[int], features: Sequence[str], most: int, seed: int) -> list[dict[str, list[float]]]:
    """Per part the cuts of its columns, told from a bounded draw of its rows (all, if they are few), in one job."""
    wanted = max(_CUT_ROWS, most * most)
    drawn = [
        part.sample(min(1.0, wanted / max(n, 1)), seed).select(F.lit(i).alias("_part"), *[col_of(c).cast("double").alias(c) for c in features])
        for i, (part, n) in enumerate(zip(parts, sizes))
    ]
    table = reduce(DataFrame.unionByName, drawn).toArrow()
    own = table.column("_part").to_numpy()
    return [{c: _cuts(table.column(c).to_numpy()[own == i].astype(float), most) for c in features} for i in range(len(parts))]


def _in_bins(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """The rows with the number of cuts below each value in its place; null for a value that is not finite."""
    cut = [c for c in cuts if cuts[c]]
    out = df
    if cut:
        # A bucket starts at its cut, where a tree sends rows left: so it starts at the next number.
        splits = [[-np.inf, *np.nextafter(cuts[c], np.inf).tolist(), np.inf] for c in cut]
        names = [f"_bin{i}" for i in range(len(cut))]
        out = Bucketizer(splitsArray=splits, inputCols=cut, outputCols=names, handleInvalid="keep").transform(out)
    place = {c: F.col(f"_bin{cut.index(c)}") if c in cut else F.lit(0.0) for c in cuts}
    finite = {c: F.abs(col_of(c).cast("double")) < float("inf") for c in cuts}
    return out.select(*[F.when(finite[c], place[c]).alias(c) if c in cuts else col_of(c) for c in df.columns])


def _merged(binned: DataFrame, by: Sequence[str | Column], features: Sequence[str]) -> DataFrame:
    """One row per group and cell of bins, with its rows (``_n``): at most bins ** columns of them, however many rows there are."""
    keys = [col_of(c) if isinstance(c, str) else c for c in by]
    return binned.groupBy(*keys, *[col_of(c) for c in features]).agg(F.count("*").alias("_n"))


def _on_cells(tree: DecisionTreeClassifier, rows: int) -> DecisionTreeClassifier:
    """The same tree on merged rows: the least rows of a leaf are asked for by weight."""
    least = tree.getMinInstancesPerNode()
    out = tree.copy().setWeightCol("_n").setMinInstancesPerNode(1)
    if 2 * least > max(rows, 2):
        return out.setMaxDepth(0)
    if least > 1:
        out.setMinWeightFractionPerNode(max((least - 0.5) / rows, tree.getMinWeightFractionPerNode()))
    return out


def _is_plain_tree(estimator: Estimator) -> bool:
    return isinstance(estimator, DecisionTreeClassifier) and not estimator.isSet("weightCol")


def _held_out_by_trees(
    rows: DataFrame, features: Sequence[str], label: str, k: int, trees: Mapping[str, Callable[[int], DecisionTreeClassifier]], seed: int
) -> DataFrame:
    """(_name, _fold, label, p1, _pred, _n): cells of held-out rows, scored by the trees that were trained without their fold.

    A tree tells only the bins of its columns apart. So the rows are merged by them, once per fold for all trees, with cuts from
    that fold's training rows; the trees are Spark's, on the cells with their rows as weights.
    """
    known = rows.where(F.col("_fold").isNotNull())
    counts = {r["_fold"]: r["count"] for r in known.groupBy("_fold").count().collect()}
    sizes = [sum(n for f, n in counts.items() if f != fold) for fold in range(k)]
    most = {name: build(max(sizes)).getMaxBins() for name, build in trees.items()}
    by = [(F.col("_fold") == F.col("_of")).alias("_held"), "_of", col_of(label).cast("double").alias(label)]
    parts = []
    for bins in sorted(set(most.values())):
        cuts = _cuts_of([known.where(F.col("_fold") != fold) for fold in range(k)], sizes, features, bins, seed)
        cells = [_merged(_in_bins(known, cuts[fold]).withColumn("_of", F.lit(fold)), by, features) for fold in range(k)]
        cells = written(reduce(DataFrame.unionByName, cells))
        for name in [name for name in trees if most[name] == bins]:
            for fold, n in enumerate(sizes):
                own = cells.where(F.col("_of") == fold)
                model = fit_pipeline(own.where(~F.col("_held")), features, _on_cells(trees[name](n), n), label)
                scored = score(model, own.where("_held"), pred="_pred")
                parts.append(scored.select(F.lit(name).alias("_name"), F.col("_of").alias("_fold"), col_of(label), "p1", "_pred", "_n"))
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    df: DataFrame,
    fit: Callable[[DataFrame], PipelineModel],
    label: str,
    key: str,
    k: int = 5,
    seed: int = 42,
    fold: str | None = None,
) -> DataFrame:
    """(fold, accuracy, roc_auc) of ``fit`` trained on the other folds, one row per fold."""
    rows = _fold_rows(df, label, k, key, seed, fold)
    try:
        got = binary_metrics(_held_out(rows, fit, label, k), label, "p1", "_pred", by=["_fold"])
        found = [tuple(r) for r in got.select("_fold", "accuracy", "roc_auc").collect()]
    finally:
        rows.unpersist()
    return literal_table(df.sparkSession, sorted(found), "fold int, accuracy double, roc_auc double")


def cv_summary(folds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over the folds."""
    return folds.groupBy(*[col_of(c) for c in by]).agg(
        F.count("*").alias("folds"),
        *[
            fn(c).alias(f"cv_{c}_{name}")
            for c in ("accuracy", "roc_auc")
            for name, fn in (("mean", F.avg), ("std", F.stddev_pop))
        ],
    )


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], top: int = 15) -> DataFrame:
    """(feature, importance) of a tree model, the highest first."""
    values = model.stages[-1].featureImportances.toArray()
    table = [(f, float(v)) for f, v in zip(features, values)]
    return (
        literal_table(df.sparkSession, table, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )


def compare_models(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    zoo: Sequence[Candidate] | None = None,
    by: str = "cv_roc_auc_mean",
    k: int = 5,
    seed: int = 42,
    baseline_family: str = "original",
    neighbours: Sequence[int] = (),
    fold: str | None = None,
) -> DataFrame:
    """Cross-validated metrics of all candidates, the best one flagged.

    ``improvement`` is the gain in ``by`` over the best model of the baseline family. Without a ``zoo`` all candidates
    of the reference are compared, votes of 3, 5 and 7 nearest rows among them; with one, ``neighbours`` adds such votes.
    """
    if zoo is None:
        zoo, neighbours = whole_zoo(), neighbours or NEIGHBOURS
    fits = {c.name: lambda part, shared, c=c: fit_candidate(part, features, label, c, shared) for c in zoo}
    family = {c.name: c.family for c in zoo}
    # Trainers pass over the rows many times: a small file would be one task's work each time.
    wanted = df.select(*[col_of(c) for c in dict.fromkeys([*features, label, key, *([fold] if fold else [])])])
    measured = _cv_of(spread(wanted, df.count()), features, fits, label, key, k, seed, neighbours, fold)
    found = [(name, family.get(name, "small_data"), *values) for name, *values in measured]
    table = literal_table(
        df.sparkSession, found, "model string, family string, " + ", ".join(f"{m} double" for m in _CV)
    )
    top = table.agg(F.min_by("model", F.struct(-col_of(by), F.col("model")))).scalar()
    base = table.where(F.col("family") == baseline_family).agg(F.max(by)).scalar()
    return table.withColumns(
        {"best": (F.col("model") == top).cast("int"), "improvement": col_of(by) - base}
    ).orderBy(F.desc(by), "model")


def _cv_of(
    df: DataFrame,
    features: Sequence[str],
    fits: Mapping[str, Callable[[DataFrame, dict], PipelineModel]],
    label: str,
    key: str,
    k: int,
    seed: int,
    neighbours: Sequence[int] = (),
    fold: str | None = None,
    trees: Mapping[str, Callable[[int], DecisionTreeClassifier]] = {},
) -> list[tuple]:
    """(name, metrics...) of several ways to fit, on the same folds; a fold's rows are scored by all its models at once.

    ``trees`` are built for n training rows and fitted on the rows merged by their bins.
    """
    wanted = dict.fromkeys([*features, label, key, *([fold] if fold else [])])
    rows = _fold_rows(df.select(*[col_of(c) for c in wanted]), label, k, key, seed, fold)
    try:
        per_fold = [_held_out_areas(rows, fits, label, k, seed)] if fits else []
        if neighbours:
            scored = written(_held_out_votes(rows, features, label, key, k, neighbours))
            per_fold.append(binary_metrics(scored, label, "p1", "_pred", by=["_name", "_fold"]))
        if trees:
            scored = written(_held_out_by_trees(rows, features, label, k, trees, seed))
            per_fold.append(binary_metrics(scored, label, "p1", "_pred", "_n", by=["_name", "_fold"]))
        per_fold = reduce(DataFrame.unionByName, [m.select("_name", "_fold", "accuracy", "roc_auc") for m in per_fold])
        return [tuple(r) for r in cv_summary(per_fold, ["_name"]).select("_name", *_CV).collect()]
    finally:
        rows.unpersist()


_CV = ("cv_accuracy_mean", "cv_accuracy_std", "cv_roc_auc_mean", "cv_roc_auc_std")


def tree_grid(depths=(2, 3, 5), leaves=(1, 3), trees=(50, 100)) -> tuple[Estimator, list[dict]]:
    """Random forest and the grid of its depth, leaf size and number of trees."""
    forest = RandomForestClassifier(seed=42)
    grid = (
        ParamGridBuilder()
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.minInstancesPerNode, list(leaves))
        .addGrid(forest.numTrees, list(trees))
        .build()
    )
    return forest, grid


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    estimator: Estimator,
    grid: Sequence[Mapping],
    k: int = 5,
    seed: int = 42,
    scale: bool = False,
    fold: str | None = None,
) -> DataFrame:
    """Cross-validated metrics for each setting of a grid, the best one flagged."""
    rows = df.withColumn(label, col_of(label).cast("double"))

    fits, trees = {}, {}
    for i, setting in enumerate(grid):
        tuned = estimator.copy(dict(setting)).setParams(labelCol=label)
        if _is_plain_tree(tuned) and not scale:
            trees[str(i)] = lambda n, tuned=tuned: tuned
        else:
            fits[str(i)] = lambda part, shared, tuned=tuned: fit_pipeline(part, features, tuned, label, scale)
    texts = [{p.name: str(v) for p, v in setting.items()} for setting in grid]
    found = [(texts[int(i)], *values) for i, *values in _cv_of(rows, features, fits, label, key, k, seed, fold=fold, trees=trees)]
    table = literal_table(
        df.sparkSession, found, "params map<string,string>, " + ", ".join(f"{m} double" for m in _CV)
    )
    top = table.agg(F.max("cv_roc_auc_mean")).scalar()
    return table.withColumn("best", (F.col("cv_roc_auc_mean") == top).cast("int")).orderBy(F.desc("cv_roc_auc_mean"))


def knn_grid(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    label: str,
    ks: Sequence[int] = (3, 5, 7),
    weights: Sequence[str] = ("uniform", "distance"),
    metrics: Sequence[str] = ("euclidean", "manhattan"),
    folds: int = 5,
    seed: int = 42,
    fold: str | None = None,
) -> DataFrame:
    """Cross-validated accuracy of neighbour votes for each k, weighting and metric, best first.

    The nearest rows of other folds are found once per metric, for all folds in one search, and written; all settings are
    measured from them.
    """
    rows = _fold_rows(df.select(*[col_of(c) for c in dict.fromkeys([id_col, vec_col, label, *([fold] if fold else [])])]), label, folds, id_col, seed, fold)
    try:
        known = rows.where(F.col("_fold").isNotNull())
        asked = known.where(F.col("_fold").between(0, folds - 1))
        near = [nearest(asked, known, max(ks), id_col, vec_col, label, m, apart="_fold").withColumn("metric", F.lit(m)) for m in metrics]
        ranked = written(reduce(DataFrame.unionByName, near))
        truth = rows.select(col_of(id_col).alias("id"), col_of(label).alias("_truth"), "_fold")
        hits = []
        for metric in metrics:
            for k in ks:
                for w in weights:
                    voted = vote(ranked.where((F.col("metric") == metric) & (F.col("rank") <= k)).drop("metric"), w)
                    hit = (F.col("prediction") == F.col("_truth")).cast("double")
                    setting = [F.lit(metric).alias("metric"), F.lit(k).alias("n_neighbors"), F.lit(w).alias("weights")]
                    hits.append(voted.join(truth, "id").select(*setting, "_fold", hit.alias("hit")))
        setting = ["metric", "n_neighbors", "weights"]
        per_fold = reduce(DataFrame.unionByName, hits).groupBy(*setting, "_fold").agg(F.avg("hit").alias("a"))
        found = [tuple(r) for r in per_fold.groupBy(*setting).agg(F.avg("a"), F.stddev_pop("a")).collect()]
    finally:
        rows.unpersist()
    names = "metric string, n_neighbors int, weights string, cv_accuracy_mean double, cv_accuracy_std double"
    return literal_table(df.sparkSession, found, names).orderBy(F.desc("cv_accuracy_mean"), *setting)


def approach_comparison(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    extra_rows: int = 100,
    trees: int = 50,
    depth: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Training on real rows, on real plus resampled rows, and baselines, on one hold-out.

    Rows: (approach, train_accuracy, val_accuracy, test_accuracy, gap). The parts are 60/20/20, and
    rows are resampled from the training part alone.
    """
    wanted = [col_of(c) for c in dict.fromkeys([*features, label, key])]
    rows = stratified_split(df.select(*wanted), label, [0.6, 0.2, 0.2], key, seed)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, val, test = (rows.where(F.col("split") == i).drop("split") for i in range(3))
        parts = {
            "traditional_small": train,
            # Written, so that no pass of a fit draws again: that groups and numbers the whole training part.
            "resample_augmented": train.unionByName(written(bootstrap(train, extra_rows, key, seed))),
        }
        forest = Candidate("forest", lambda n: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed))
        scored = []
        for name, data in parts.items():
            model = fit_candidate(data, features, label, forest)
            for part, on in ((data, "train"), (val, "val"), (test, "test")):
                hits = score(model, part, pred="_pred").select(col_of(label), "p1", "_pred")
                scored.append(hits.withColumns({"_approach": F.lit(name), "_on": F.lit(on)}))
        measured = binary_metrics(
            reduce(DataFrame.unionByName, scored), label, "p1", "_pred", by=["_approach", "_on"]
        )
        got = {(r["_approach"], r["_on"]): r["accuracy"] for r in measured.collect()}
        found = []
        for name in parts:
            values = [got[name, on] for on in ("train", "val", "test")]
            found.append((name, *values, values[0] - values[2]))
        for b in baseline_metrics(train, test, label).collect():
            found.append((b["approach"], None, None, float(b["test_accuracy"]), None))
    finally:
        rows.unpersist()
    return literal_table(
        df.sparkSession, found, "approach string, train_accuracy double, val_accuracy double, test_accuracy double, gap double"
    )


# ---------------------------------------------------------------- feature choice


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, f_score): variance between the label's groups over variance within them."""
    groups = (
        df.where(col_of(label).isNotNull())
        .groupBy(col_of(label).alias("_label"))
        .agg(
            *[F.count(col_of(f)).cast("double").alias(f"n{i}") for i, f in enumerate(features)],
            *[F.avg(col_of(f)).alias(f"m{i}") for i, f in enumerate(features)],
            *[F.var_pop(col_of(f)).alias(f"v{i}") for i, f in enumerate(features)],
        )
    )
    overall = moments(df.where(col_of(label).isNotNull()), features)
    parts = []
    for i, _ in enumerate(features):
        n, m, v = F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"v{i}")
        parts += [
            F.sum(n).alias(f"rows{i}"),
            F.sum(n * (m - F.col("_all")[f"m{i}"]) * (m - F.col("_all")[f"m{i}"])).alias(f"between{i}"),
            F.sum(n * v).alias(f"within{i}"),
        ]
    row = groups.withColumn("_all", overall).agg(F.count("*").alias("k"), *parts)
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.try_divide(
                F.col(f"between{i}") / (F.col("k") - 1), F.col(f"within{i}") / (F.col(f"rows{i}") - F.col("k"))
            ).alias("f_score"),
        )
        for i, f in enumerate(features)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int = 5) -> DataFrame:
    """The k features with the highest F score."""
    return anova_f(df, features, label).orderBy(F.desc_nulls_last("f_score"), "feature").limit(k)
