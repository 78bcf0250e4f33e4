"""The comparison has all candidates of the reference: votes of neighbours, extra-trees and Gaussian support vectors among them."""

import numpy as np
import pytest

from chartmill.catalog import learning
from chartmill.operators import models as Z
from chartmill.operators.extra_trees import ExtraTreesClassifier
from chartmill.operators.kernel_svm import RbfSVC

REFERENCE = {
    *(f"KNN (k={k})" for k in (3, 5, 7)),
    *(f"Linear SVM (C={c})" for c in (0.01, 0.1, 1.0)),
    *(f"Lasso Logistic (C={c})" for c in (0.01, 0.1)),
    "Ridge Logistic (C=0.1)",
    "Ridge Classifier",
    "Decision Tree (depth=2)",
    "Decision Tree (depth=3)",
    "Logistic + Feature Selection",
    "Extra Trees (constrained)",
    "Gradient Boosting (regularized)",
    "SVM (RBF) - Original",
    "Random Forest - Original",
    "Naive Bayes - Original",
}


def _rows(spark, n, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = ((x**2).sum(axis=1) + 0.5 * rng.normal(size=n) > 1.3).astype(int)
    return x, y, spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id bigint, a double, b double, y int")


def test_query_compares_all_candidates_on_five_folds(monkeypatch):
    seen = []
    monkeypatch.setattr(learning.Z, "_cv_of", lambda df, features, fits, label, key, k, seed, neighbours, fold: seen.append((fits, k, neighbours)) or [])
    monkeypatch.setattr(learning.Z, "spread", lambda rows, n: rows)
    monkeypatch.setattr(learning.Z, "literal_table", lambda *args: (_ for _ in ()).throw(StopIteration))
    monkeypatch.setattr(learning, "planted", lambda t: type("Rows", (), {"select": lambda s, *c: s, "count": lambda s: 0, "sparkSession": None})())
    monkeypatch.setattr(learning.Z, "col_of", lambda c: c)
    with pytest.raises(StopIteration):
        learning.model_comparison(None)
    ((fits, k, neighbours),) = seen
    assert {*fits, *(f"KNN (k={n})" for n in neighbours)} == REFERENCE and k == 5


def test_round_classes_need_the_new_candidates(spark):
    _, _, df = _rows(spark, 240)
    zoo = [c for c in Z.whole_zoo() if c.name in ("SVM (RBF) - Original", "Extra Trees (constrained)", "Ridge Logistic (C=0.1)")]
    got = {r["model"]: r for r in Z.compare_models(df, ["a", "b"], "y", "id", zoo, k=2).collect()}
    assert got["SVM (RBF) - Original"]["cv_roc_auc_mean"] > 0.85 and got["SVM (RBF) - Original"]["family"] == "original"
    assert got["Extra Trees (constrained)"]["cv_roc_auc_mean"] > 0.75
    assert got["Ridge Logistic (C=0.1)"]["cv_roc_auc_mean"] < 0.7


def test_gaussian_support_vectors_are_at_the_optimum(spark):
    x, y, df = _rows(spark, 150)
    model = Z.fit_pipeline(df, ["a", "b"], RbfSVC(c=1.0, kernel_tol=1e-8, gap=1e-6).setParams(labelCol="y"), "y")
    p1 = np.array([r["p1"] for r in Z.score(model, df).orderBy("id").collect()])
    margin = np.log(p1 / (1 - p1))
    # The dual by pairs of rows, the most violating first, as libsvm does it.
    sign, gamma = 2.0 * y - 1, 1.0 / (2 * x.var())
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    a = np.zeros(len(x))
    for _ in range(100_000):
        f = kernel @ (a * sign)
        up, low = ((sign > 0) & (a < 1)) | ((sign < 0) & (a > 0)), ((sign > 0) & (a > 0)) | ((sign < 0) & (a < 1))
        i, j = np.where(up, sign - f, -np.inf).argmax(), np.where(low, sign - f, np.inf).argmin()
        wrong = (sign - f)[i] - (sign - f)[j]
        if wrong < 1e-7:
            break
        room = min((1 - a[i]) if sign[i] > 0 else a[i], a[j] if sign[j] > 0 else 1 - a[j])
        step = min(wrong / max(2 - 2 * kernel[i, j], 1e-12), room)
        a[i], a[j] = a[i] + step * sign[i], a[j] - step * sign[j]
    constant = ((sign - f)[i] + (sign - f)[j]) / 2
    assert margin == pytest.approx(f + constant, abs=5e-3)
    # Bounds as they are by default change little.
    rough = Z.score(Z.fit_pipeline(df, ["a", "b"], RbfSVC().setParams(labelCol="y"), "y"), df).orderBy("id").collect()
    assert np.abs(np.array([r["p1"] for r in rough]) - p1).max() < 0.02


def test_extra_trees_count_what_reaches_their_leaves(spark):
    x, y, df = _rows(spark, 300, seed=5)
    df = df.selectExpr("id", "a", "b", "CAST(1 AS DOUBLE) AS c", "y")
    x = np.column_stack([x, np.ones(len(x))])
    fitted = Z.fit_pipeline(df, ["a", "b", "c"], ExtraTreesClassifier(20, 2, 5, 10).setParams(labelCol="y"), "y")
    trees, want = fitted.stages[-1].trees, np.zeros(len(x))
    # A cut too near the edge leaves a leaf; the constant column is never cut.
    cut = trees.cut[trees.column[:, 0] >= 0, 0]
    assert len(cut) > 10 and len(np.unique(cut)) == len(cut) and set(np.unique(trees.column)) == {-1, 0, 1}
    for t in range(20):
        at = np.zeros(len(x), int)
        for _ in range(2):
            inner = trees.column[t, at] >= 0
            at = np.where(inner, np.where(x[np.arange(len(x)), trees.column[t, at]] <= trees.cut[t, at], 2 * at + 1, 2 * at + 2), at)
        for leaf in np.unique(at):
            here = at == leaf
            assert here.sum() >= 5 and list(trees.counts[t, leaf]) == [(y[here] == 0).sum(), (y[here] == 1).sum()]
            want[here] += y[here].mean() / 20
    got = Z.score(fitted, df).orderBy("id").collect()
    assert [r["p1"] for r in got] == pytest.approx(want)
    assert [r["prediction"] for r in got] == [int(v > 0.5) for v in want]


def test_votes_of_rows_whose_keys_repeat_or_are_null(spark):
    x, y, _ = _rows(spark, 120)
    rows = [(None if i % 5 == 0 else i % 7, float(a), float(b), int(c), i % 3) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y int, f int")
    got = {r["model"]: r for r in Z.compare_models(df, ["a", "b"], "y", "id", [c for c in Z.model_zoo() if "Bayes" in c.name], k=3, neighbours=(3,), fold="f").collect()}
    hits = []
    for fold in range(3):
        held = np.arange(120) % 3 == fold
        mean, spread = x[~held].mean(axis=0), x[~held].std(axis=0, ddof=1)
        z = (x - mean) / spread
        d = np.sqrt(((z[held][:, None] - z[~held][None]) ** 2).sum(axis=2))
        near = np.argsort(d, axis=1)[:, :3]
        w = 1 / np.take_along_axis(d, near, axis=1)
        share = (w * y[~held][near]).sum(axis=1) / w.sum(axis=1)
        hits.append(((share > 0.5) == y[held]).mean())
    assert got["KNN (k=3)"]["cv_accuracy_mean"] == pytest.approx(np.mean(hits))
