from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from chartmill.operators import clusters as K
from chartmill.operators import models as Z
from chartmill.operators import neighbours as N


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=3)], int(rng.integers(0, 3))) for i in range(120)]
    rows[7] = (7, rows[8][1], 0)  # equal vectors
    return rows, spark.createDataFrame(rows, "id bigint, v array<double>, c int").cache()


def _plain(rows):
    x = np.array([r[1] for r in rows])
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), np.array([r[2] for r in rows])


@pytest.mark.parametrize("block_rows", [10, 4096])
def test_nearest_over_blocks(points, block_rows):
    rows, df = points
    d, _ = _plain(rows)
    got = {}
    for r in N.nearest(df, df, 4, "id", "v", "c", skip_self=True, block_rows=block_rows).collect():
        got[r["id"], r["rank"]] = r["ref_id"]
    np.fill_diagonal(d, np.inf)
    for i in range(len(rows)):
        order = sorted(range(len(rows)), key=lambda j: (d[i, j], j))[:4]
        assert [got[i, k + 1] for k in range(4)] == order


def test_zero_distance_decides_the_vote(points):
    rows, df = points
    got = {r["id"]: r for r in N.knn_vote(df, df, 5, "id", "v", "c").collect()}
    assert all(got[r[0]]["probability"] == 1.0 for r in rows if r[0] not in (7, 8))


def test_silhouette_over_blocks(points):
    rows, df = points
    d, c = _plain(rows)
    scores = []
    for i in range(len(rows)):
        own = c == c[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        scores.append((b - a) / max(a, b))
    for block_rows in (17, 4096):
        got = K.silhouette(df, "id", "v", "c", sample=None, block_rows=block_rows).first()[0]
        assert got == pytest.approx(np.mean(scores), abs=1e-7)


def test_row_alone_in_its_cluster(table):
    df = table([(1, [0.0], 0), (2, [1.0], 1), (3, [2.0], 1)], "id bigint, v array<double>, c int")
    # Row 1: 0. Row 2: a = b = 1, so 0. Row 3: (2 - 1) / 2.
    assert K.silhouette(df, "id", "v", "c").first()[0] == pytest.approx(0.5 / 3)


def test_interaction_terms(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *[float(x) for x in rng.normal(size=4)], int(rng.integers(0, 2))) for i in range(60)]
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int")
    model = Z.logistic_interactions(df, cols, "y", max_iter=5)
    got = model.transform(df).select(vector_to_array("scaled"), vector_to_array("terms")).collect()
    for scaled, terms in got:
        expected = scaled + [x * y for x, y in combinations(scaled, 2)]
        assert sorted(terms) == pytest.approx(sorted(expected))


def test_ridge_is_the_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=80) > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, y int")
    ridge = next(c for c in Z.model_zoo() if c.name == "Ridge Classifier")
    got = [r["_pred"] for r in Z.score(Z.fit_candidate(df, ["a", "b"], "y", ridge), df, pred="_pred").collect()]
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (2 * y - 1))
    expected = (z @ w + (2 * y - 1).mean() >= 0).astype(int)
    assert np.mean(np.array(got) == expected) > 0.97


def test_comparison_with_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 2))
    rows = [(i, float(a), float(b) * 50, int(a + b > 0)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y int")
    zoo = [c for c in Z.model_zoo() if c.name in ("Ridge Logistic (C=0.1)", "Naive Bayes - Original")]
    got = {r["model"]: r for r in Z.compare_models(df, ["a", "b"], "y", "id", zoo, k=3, neighbours=(3, 5)).collect()}
    assert set(got) == {"Ridge Logistic (C=0.1)", "Naive Bayes - Original", "KNN (k=3)", "KNN (k=5)"}
    assert sum(r["best"] for r in got.values()) == 1
    assert all(r["cv_accuracy_mean"] > 0.85 and 0.85 < r["cv_roc_auc_mean"] <= 1 for r in got.values())
    assert got["Naive Bayes - Original"]["improvement"] == 0.0


def test_training_report(spark):
    from chartmill.plans.readmission import train

    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 2))
    rows = [(i, float(a), float(b), int(a + 0.3 * c > 0.8)) for i, ((a, b), c) in enumerate(zip(x, rng.normal(size=400)))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y int")
    report = train(df, ["a", "b"], "y", "id", Z.BoostConfig(trees=4, step=0.3, depth=2, min_leaf=5), folds=2)
    test = report.test.first()
    assert test["roc_auc"] > 0.8 and test["n"] == test["tn"] + test["fp"] + test["fn"] + test["tp"]
    assert report.importance.first()["feature"] == "a"
    summary = report.cross_validation.first()
    assert summary["folds"] == 2 and 0 <= summary["cv_roc_auc_std"] < 0.2
    assert set(report.gap.first().asDict()) == {"train_accuracy", "test_accuracy", "gap", "warning", "gap_band"}


def test_zoo_builds_every_model():
    names = [c.name for c in Z.model_zoo()]
    assert len(names) == len(set(names)) == 13
    assert all(c.build(100) is not None for c in Z.model_zoo())


def test_as_many_groups_as_asked_for(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=2) * 0.1 + (i % 12) * 5]) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").withColumn("features", array_to_vector("v"))
    assert len(K.fit_kmeans(df, 12, seeds=[1, 2]).clusterCenters()) == 12
    scan = {r["k"]: r for r in K.k_scan(df, "id", ks=(8, 12), seeds=[1, 2]).collect()}
    assert set(scan) == {8, 12} and scan[12]["inertia"] < scan[8]["inertia"] / 2 and scan[12]["best"] == 1
    with pytest.raises(ValueError):
        K.fit_kmeans(df, 1)


def test_projected_centroids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=3) + (i % 2) * 9]) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").withColumn("features", array_to_vector("v"))
    kmeans, pca = K.fit_kmeans(df, 2, seeds=[1, 2]), K.fit_pca(df)
    got = K.project_centroids(kmeans, pca, df).collect()
    assert len(got) == 2 and abs(got[0]["pc1"] - got[1]["pc1"]) > 5
    assigned = kmeans.setPredictionCol("cluster").transform(df)
    assert assigned.groupBy("cluster").agg(F.count_distinct(F.col("id") % 2).alias("n")).where("n > 1").count() == 0


def test_many_groups_join_as_few_do(spark):
    from chartmill.operators.lookup import attach
    from chartmill.operators.sampling import balanced_weights

    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 700).alias("k"), F.col("id"))
    table = df.groupBy("k").agg(F.count("*").alias("n"))
    few, many = (sorted(map(tuple, attach(df, "k", table, "k", "n", "n", few=f).collect()), key=str) for f in (10_000, 5))
    assert few == many and len(few) == 3000
    labels = spark.range(30_000).withColumn("y", F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")))
    got = balanced_weights(labels, "y").groupBy((F.col("y") == -1).alias("hot")).agg(F.min("weight"), F.max("weight"), F.count("*")).collect()
    want = 30_000 / 20_001
    assert {tuple(round(x, 9) for x in r[1:]) for r in got} == {(round(want / 10_000, 9),) * 2 + (10_000,), (round(want, 9),) * 2 + (20_000,)}


def test_measures_of_many_clusters(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=2)], i % 1100) for i in range(3300)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, c int")
    x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    centres = np.array([x[c == k].mean(axis=0) for k in range(1100)])
    assert K.inertia(df, "v", "c").first()[0] == pytest.approx(((x - centres[c]) ** 2).sum())
    s = np.array([np.sqrt(((x[c == k] - centres[k]) ** 2).sum(axis=1)).mean() for k in range(1100)])
    d = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = ((s[:, None] + s[None]) / d).max(axis=1).mean()
    assert K.davies_bouldin(df, "v", "c", block_rows=400).first()[0] == pytest.approx(want)


def test_trees_on_merged_rows_are_those_on_rows(spark):
    from pyspark.ml.classification import DecisionTreeClassifier

    rng = np.random.default_rng(21)
    x = np.column_stack([rng.normal(size=3_000), rng.integers(0, 4, size=3_000), np.ones(3_000)])
    y = (x[:, 0] + x[:, 1] / 2 + rng.normal(size=3_000) > 0.8).astype(int)
    rows = [(i, *map(float, v), int(c), i % 3) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, y int, f int").repartition(4).persist()
    seen = []
    plain = Z.fit_pipeline
    for depth, least in ((3, 1), (2, 300)):
        tree = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=least, seed=1)
        want = Z.cross_validate(df, lambda part: plain(part, ["a", "b", "c"], tree.copy().setLabelCol("y"), "y"), "y", "id", 3, fold="f")
        want = Z.cv_summary(want).first()

        def counting(part, *args, **kwargs):
            seen.append(part.count())
            return plain(part, *args, **kwargs)

        Z.fit_pipeline = counting
        try:
            got = Z.grid_search(df, ["a", "b", "c"], "y", "id", tree, [{tree.maxDepth: depth}], 3, fold="f").first()
        finally:
            Z.fit_pipeline = plain
        assert [got[c] for c in Z._CV] == pytest.approx([want[c] for c in Z._CV], abs=1e-12)
    # At most 32 * 4 cells of two labels, where there are 2,000 rows.
    assert len(seen) == 6 and max(seen) <= 256


def test_draws_are_made_once(spark, monkeypatch):
    rng = np.random.default_rng(22)
    rows = [(i, float(a), int(a + b > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "id bigint, a double, y int")
    kept = []
    monkeypatch.setattr(Z, "written", lambda d, real=Z.written: kept.append(real(d)) or kept[-1])
    got = {r["approach"]: r for r in Z.approach_comparison(df, ["a"], "y", "id", extra_rows=40, trees=3).collect()}
    assert len(got) == 4 and 0.5 < got["resample_augmented"]["test_accuracy"] <= 1
    assert [d.count() for d in kept] == [40]


def test_models_of_a_fold_share_its_scaler_and_score_its_rows_at_once(spark, monkeypatch):
    """Scaled rows, scores and their metrics are made once per fold for all models, and no scored rows are written."""
    rows = spark.range(600).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id * 31 % 23 AS DOUBLE) AS b", "CAST(id % 17 + id * 7 % 11 > 13 AS INT) AS y")
    kinds = ("Ridge Logistic (C=0.1)", "Ridge Classifier", "Decision Tree (depth=3)")
    zoo = [c for c in Z.model_zoo() if c.name in kinds]
    scalers, kept = [], []
    monkeypatch.setattr(Z, "_scaler", lambda make=Z._scaler: (scalers.append(1), make())[1])
    monkeypatch.setattr(Z, "written", lambda df, keep=Z.written: (kept.append(df.columns), keep(df))[1])
    got = {r["model"]: r for r in Z.compare_models(rows, ["a", "b"], "y", "id", zoo, k=2).collect()}
    assert len(scalers) == 2 and not kept
    for c in zoo:
        one = Z.cv_summary(Z.cross_validate(rows, lambda part, c=c: Z.fit_candidate(part, ["a", "b"], "y", c), "y", "id", k=2)).first()
        assert all(got[c.name][m] == pytest.approx(one[m], abs=1e-12) for m in Z._CV)
