"""K-Means of many settings at once."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector

from chartmill.operators import clusters as K
from chartmill.operators import lloyd as M


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2)) + rng.integers(0, 4, size=(300, 1)) * [6.0, -4.0] + 1000.0
    df = spark.createDataFrame([([float(z) for z in v],) for v in x], "v array<double>").repartition(5).cache()
    return x, df


def test_every_fit_is_at_rest(cloud):
    x, df = cloud
    pairs = [(k, seed) for k in (2, 4, 7) for seed in (0, 1)]
    fits = M.fit_many(df, pairs)
    assert [(f.k, f.seed) for f in fits] == pairs
    for f in fits:
        d = ((x[:, None] - f.centres[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        assert f.inertia == pytest.approx(d.min(axis=1).sum(), rel=1e-6) and 1 <= f.steps < 100
        for c in range(f.k):
            assert f.centres[c] == pytest.approx(x[own == c].mean(axis=0), abs=1e-3)
    assert fits[2].inertia == pytest.approx(sum(((g - g.mean(axis=0)) ** 2).sum() for g in _quarters(x)), rel=0.2)


def _quarters(x):
    at = np.clip(np.round((x[:, 0] - 1000) / 6), 0, 3)
    return [x[at == i] for i in range(4)]


def test_one_pass_per_step_for_all_settings(cloud, monkeypatch):
    _, df = cloud
    steps, own = [], M._step

    def counted(vectors, pairs):
        steps.append(len(pairs))
        return own(vectors, pairs)

    monkeypatch.setattr(M, "_step", counted)
    fits = M.fit_many(df, [(2, 0), (6, 0), (6, 1)])
    assert steps[0] == 3 and len(steps) == max(f.steps for f in fits) and sum(steps) == sum(f.steps for f in fits)


def test_silhouettes_of_all_settings(cloud):
    _, df = cloud
    fits = M.fit_many(df, [(2, 0), (4, 1), (9, 1)])
    got = M.squared_silhouettes(df, [f.centres for f in fits])
    rows = df.select(array_to_vector("v").alias("features"))
    for f, value in zip(fits, got):
        labelled = K.as_model(df.sparkSession, f.centres).transform(rows)
        assert value == pytest.approx(ClusteringEvaluator().evaluate(labelled), abs=1e-6)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 2.0],)] * 3, "v array<double>")
    fit = M.fit_many(df, [(4, 0)])[0]
    assert sorted(map(tuple, fit.centres)) == [(1.0, 2.0), (3.0, 2.0)] and fit.inertia == 0.0
    assert M.fit_many(df.limit(0), [(2, 0)]) == []
    one = M.fit_many(df.where("v[0] = 1"), [(3, 0)])[0]
    assert len(one.centres) == 1 and M.squared_silhouettes(df, [one.centres]) == [None]
    model = K.fit_kmeans(df.withColumn("features", array_to_vector("v")), 2, seeds=[1])
    assert len(model.clusterCenters()) == 2
    with pytest.raises(ValueError):
        K.fit_kmeans(df.limit(0).withColumn("features", array_to_vector("v")), 2)
