"""Silhouette from bounds: the proven error holds, and the value is close to that of all pairs."""

import numpy as np
import pytest

from chartmill.operators import distance_bounds as D


def plain(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = c == c[i]
        a = d[i, own].sum() / max(own.sum() - 1, 1)
        b = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        out.append(0.0 if own.sum() == 1 or max(a, b) == 0 else (b - a) / max(a, b))
    return np.array(out)


def groups(kind, n=240):
    rng = np.random.default_rng(3)
    c = rng.integers(0, 3, size=n)
    if kind == "near":
        return rng.normal(size=(n, 2)) + c[:, None] * 1.5, c
    if kind == "far":
        return rng.normal(size=(n, 3)) * 0.1 + c[:, None] * 50.0 + 1000.0, c
    if kind == "wide":
        return rng.normal(size=(n, 40)), c
    x = rng.integers(0, 3, size=(n, 2)).astype(float)  # many equal rows
    c[0] = 7  # alone
    x[: n // 3] = x[0]
    return x, c


def frame(spark, x, c):
    rows = [([float(z) for z in v], f"g{k}") for v, k in zip(x, c)] + [([0.0] * x.shape[1], None)]
    return spark.createDataFrame(rows, "v array<double>, c string").repartition(3)


@pytest.mark.parametrize("kind", ["near", "far", "wide", "equal"])
def test_error_holds(spark, kind):
    x, c = groups(kind)
    exact = plain(x, c).mean()
    for error in (0.5, 0.02):
        r = D.silhouette_within(frame(spark, x, c), "v", "c", error).first()
        assert r["error"] <= error and abs(r["silhouette"] - exact) <= r["error"] + 1e-9


def test_bounds_of_every_row(spark):
    x, c = groups("near")
    df = frame(spark, x, c).where("c IS NOT NULL").selectExpr("CAST(substr(c, 2) AS int) AS own", "v")
    pivots = {k: x[c == k][:5] for k in range(3)}
    cells = D._moments(df, pivots, 2)
    assert cells.n.sum() == len(x)
    home = np.searchsorted(cells.number, D._place(x, c, pivots, D._numbered(pivots)))
    s, off, _ = D.bounded_scores(cells, 3, x, c, home)
    assert (np.abs(s - plain(x, c)) <= off + 1e-9).all() and off.mean() < 0.3


def test_one_group_or_no_rows(spark):
    x, _ = groups("near")
    one = frame(spark, x, np.zeros(len(x), int))
    assert tuple(D.silhouette_within(one, "v", "c").first()) == (None, None)
    assert tuple(D.silhouette_within(one.limit(0), "v", "c").first()) == (None, None)


def test_bounded_memory_ends_the_splitting(spark, monkeypatch):
    monkeypatch.setattr(D, "NUMBERS", 100)
    x, c = groups("near")
    r = D.silhouette_within(frame(spark, x, c), "v", "c", 0.001).first()
    assert 0.001 < r["error"] and abs(r["silhouette"] - plain(x, c).mean()) <= r["error"]
