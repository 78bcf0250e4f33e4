"""Proofs of fitted models, and neighbours across slices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartmill.operators import fit_checks as C
from chartmill.operators import models as Z
from chartmill.operators import ordered as O
from chartmill.operators.metrics import roc_curve


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [2, 256])
def test_neighbours_across_slices(table, descending, slices):
    """Groups have gaps, so many slices hold no row of theirs."""
    rng = random.Random(5)
    values = {(g, v): rng.randint(0, 9) for g, low in (("x", 0), ("y", 500), (None, 0)) for v in rng.sample(range(low, low + 900), 120)}
    df = table([(g, float(v), n) for (g, v), n in values.items()], "g string, v double, n int")
    got = O.running_totals(df, "v", ["n"], ["g"], descending, slices, beside=["v", "n"]).collect()
    assert len(got) == len(values)
    for g in ("x", "y", None):
        line = sorted((v for h, v in values if h == g), reverse=descending)
        want = {v: (a, b) for v, a, b in zip(line, [None, *line], [*line[1:], None])}
        for r in got:
            if r["g"] == g:
                before, after = want[r["v"]]
                assert (r["prev_v"], r["next_v"]) == (before, after)
                assert (r["prev_n"], r["next_n"]) == (values.get((g, before)), values.get((g, after)))


def test_corner_points_do_not_join_on_rates(table):
    rng = np.random.default_rng(2)
    rows = [(float(s), int(y)) for s, y in zip(rng.permutation(400) / 400, rng.random(400) < 0.2)]
    df = table(rows, "s double, y int")
    corners = roc_curve(df, "y", "s", drop_intermediate=True)
    plan = corners._jdf.queryExecution().optimizedPlan().toString()
    assert "fpr" not in "".join(line for line in plan.splitlines() if "Join" in line)
    full = [(r["fpr"], r["tpr"]) for r in roc_curve(df, "y", "s").collect()][1:]
    kept = [
        p for i, p in enumerate(full)
        if i in (0, len(full) - 1) or not any(full[i - 1][a] == p[a] == full[i + 1][a] for a in (0, 1))
    ]
    assert [(r["fpr"], r["tpr"]) for r in corners.collect()][1:] == kept


def test_optimum_and_what_is_none(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.2]
    y = (x[:, 0] + rng.normal(size=200) > 0.5).astype(int)
    df = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(x, y)], "a double, b double, c double, y int")
    from chartmill.operators.sampling import balanced_weights

    rows = balanced_weights(df, "y", "w")
    names = Z.interaction_terms(["a", "b", "c"])
    assert names == ["a", "b", "a x b", "c", "a x c", "b x c"]
    good, early = (Z.logistic_interactions(df, ["a", "b", "c"], "y", max_iter=n) for n in (2000, 1))
    at = {m: C.logistic_optimality(m, rows, "y", "w", names).collect() for m in (good, early)}
    assert [r["term"] for r in at[good]] == ["constant", *names]
    assert max(abs(r["gradient"]) for r in at[good]) < 1e-6 < 1e-3 < max(abs(r["gradient"]) for r in at[early])
    with pytest.raises(ValueError):
        C.logistic_optimality(Z.train_gbt(df, ["a"], "y", Z.BoostConfig(trees=1, min_leaf=1)), df, "y")


def test_gains_of_all_cuts(table):
    rng = np.random.default_rng(6)
    rows = [(float(rng.integers(0, 6)), float(rng.normal()), float(rng.normal()), float(rng.random())) for _ in range(80)]
    rows += [(None, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0), (1.0, 1.0, None, 1.0)]
    df = table(rows, "a double, b double, r double, w double")
    got = {(r["feature"], round(r["threshold"], 9)): (r["rows_left"], r["gain"]) for r in C.split_gains(df, ["a", "b"], "r", "w", 5).collect()}
    want = {}
    for i, name in enumerate("ab"):
        own = [(v[i], v[2], v[3]) for v in rows if v[2] is not None and v[i] is not None and v[i] == v[i]]
        x, r, w = (np.array(c) for c in zip(*own))
        values = np.unique(x)

        def variance(at, r=r, w=w):
            return np.average((r[at] - np.average(r[at], weights=w[at])) ** 2, weights=w[at]) * w[at].sum() / w.sum()

        for low, high in zip(values, values[1:]):
            left = x <= low
            if left.sum() >= 5 and (~left).sum() >= 5:
                gain = variance(np.ones(len(x), bool)) - variance(left) - variance(~left)
                want[name, round((low + high) / 2, 9)] = (int(left.sum()), pytest.approx(gain, abs=1e-9))
    assert got == want
    assert C.split_gains(df.limit(0), ["a"], "r").count() == 0


def test_root_of_the_first_tree(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 8, size=(600, 2))
    rows = [(float(a), float(b), int(b + rng.normal() > 4.2)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, y int").withColumn("r", 2.0 * F.col("y") - 1)
    config = Z.BoostConfig(trees=2, depth=2, row_share=1.0, feature_subset="all")
    r = C.root_check(Z.train_gbt(df, ["a", "b"], "y", config, balanced=False), df, ["a", "b"], "r").first()
    assert r["feature"] == "b" and r["gain"] == r["best_gain"] > 0.2
