"""Cross-validation from moments, against models trained on the rows."""

import numpy as np
import pytest
from conftest import TINY

from chartmill.operators import downdating as D


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 3)) * [1.0, 20.0, 0.1] + [5.0, 1e6, 0.0]
    y = ((x[:, 0] - 5) + (x[:, 1] - 1e6) / 20 + 0.7 * rng.normal(size=300) > 0).astype(int)
    fold = rng.integers(0, 4, size=300)
    rows = [(*map(float, v), int(c), int(f)) for v, c, f in zip(x, y, fold)]
    odd = [(None, 1.0, 2.0, 1, 0), (float("nan"), 1.0, 2.0, 0, 1), (1.0, 1.0, 1.0, None, 1), (1.0, 1.0, 1.0, 1, None)]
    df = spark.createDataFrame(rows + odd, "a double, b double, c double, y int, f int").repartition(3)
    return x, y, fold, df


def test_moments_of_a_fold_are_the_rest(sample):
    x, y, fold, df = sample
    stats = D.fold_statistics(df, ["a", "b", "c"], "y", "f")
    assert stats.folds == [0, 1, 2, 3]
    for f in (None, 0, 3):
        for c, m in enumerate(stats.trained(f)):
            own = x[(y == c) & (fold != (-1 if f is None else f))]
            assert m.n == len(own) and m.mean + stats.shift == pytest.approx(own.mean(axis=0))
            assert m.scatter == pytest.approx(np.cov(own.T) * (len(own) - 1), rel=1e-6)


def test_models_are_those_of_the_other_folds(sample):
    x, y, fold, df = sample
    stats = D.fold_statistics(df, ["a", "b", "c"], "y", "f")
    for f in range(4):
        own, t = x[fold != f], 2.0 * y[fold != f] - 1
        mean, sd = own.mean(axis=0), own.std(axis=0, ddof=1)
        z = (own - mean) / sd
        for penalty in (0.5, 30.0):
            w = np.linalg.solve(z.T @ z + penalty * np.eye(3), z.T @ t)
            model = D.ridge(stats, f, penalty)
            got = x[fold == f] @ model.weights + model.constant
            assert got == pytest.approx(((x[fold == f] - mean) / sd) @ w + t.mean(), abs=1e-5)
        bell = D.naive_bayes(stats, f)
        for c in (0, 1):
            part = own[t == 2 * c - 1]
            assert bell.mean[c] == pytest.approx(part.mean(axis=0))
            assert bell.variance[c] == pytest.approx(part.var(axis=0) + 1e-9 * own.var(axis=0).max(), rel=1e-6)


def test_accuracy_and_area_per_fold(sample):
    x, y, fold, df = sample
    got = {(r["model"], r["fold"]): r for r in D.cross_validate_closed(df, ["a", "b", "c"], "y", "f", (1.0, 100.0)).collect()}
    assert len(got) == 12
    stats = D.fold_statistics(df, ["a", "b", "c"], "y", "f")
    for f in range(4):
        model = D.ridge(stats, f, 100.0)
        m, truth = x[fold == f] @ model.weights + model.constant, y[fold == f]
        r = got["Ridge (penalty=100)", f]
        assert r["n"] == len(truth) and r["accuracy"] == pytest.approx(((m >= 0) == truth).mean())
        pairs = m[truth == 1][:, None] - m[truth == 0][None]
        assert r["roc_auc"] == pytest.approx(((pairs > 0) + 0.5 * (pairs == 0)).mean())
        own, c, held = x[fold != f], y[fold != f], x[fold == f]
        log = []
        for part in (own[c == 0], own[c == 1]):
            spread = (held - part.mean(axis=0)) ** 2 / part.var(axis=0) + np.log(part.var(axis=0))
            log.append(np.log(len(part)) - spread.sum(axis=1) / 2)
        assert got["Gaussian Naive Bayes", f]["accuracy"] == pytest.approx(((log[1] >= log[0]) == truth).mean())


def test_one_class_a_constant_column_and_no_rows(spark):
    rows = [(1.0, float(i % 7), int(i % 7 > 3), i % 2) for i in range(60)] + [(1.0, 2.0, 0, 2)]
    df = spark.createDataFrame(rows, "a double, b double, y int, f int")
    got = D.cross_validate_closed(df, ["a", "b"], "y", "f").collect()
    assert {r["fold"] for r in got} == {0, 1, 2} and all(r["accuracy"] == 1.0 for r in got if r["model"].startswith("Ridge"))
    assert [r["roc_auc"] for r in got if r["fold"] == 2] == [None, None]
    assert D.cross_validate_closed(df.where("y = 1"), ["a", "b"], "y", "f").count() == 0
    assert D.cross_validate_closed(df.limit(0), ["a", "b"], "y", "f").count() == 0


def test_one_scan_and_one_exchange(spark):
    lines = spark.read.parquet(f"{TINY}/lineitem.parquet").selectExpr("l_linenumber % 5 AS f", "l_returnflag = 'R' AS y", "l_tax", "l_discount")
    plan = D.moment_sums(D._rows(lines, ["l_tax", "l_discount"], "y", "f"), 2, np.zeros(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
