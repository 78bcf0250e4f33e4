"""Nearest neighbours through the metric index, against all pairs."""

import numpy as np
import pandas as pd
import pytest

from chartmill.operators import metric_index as M
from chartmill.operators import models as Z
from chartmill.operators import neighbours as N


def brute(rows, queries, k, metric, skip_self):
    out = {}
    for i, v in queries:
        if v is None:
            continue
        gaps = [(float(np.abs(np.subtract(v, w)).sum() if metric == "manhattan" else np.sqrt(((np.subtract(v, w)) ** 2).sum())), j, c) for j, w, c in rows if w is not None and not (skip_self and i == j)]
        for rank, (d, j, c) in enumerate(sorted(g for g in gaps if np.isfinite(g[0]))[:k], 1):
            out[i, rank] = (j, c, d)
    return out


def groups(rng, n, many, dims=3, spread=0.05):
    centres = rng.normal(size=(many, dims)) * 10
    return centres[rng.integers(0, many, size=n)] + rng.normal(size=(n, dims)) * spread


def frame(spark, x, label=None):
    rows = [(i, [float(z) for z in v], int(i % 3 if label is None else label[i])) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows, "id bigint, v array<double>, c int").repartition(4)


@pytest.mark.parametrize("kind, metric", [("groups", "manhattan"), ("noise", "euclidean"), ("lattice", "euclidean")])
def test_index_finds_what_all_pairs_find(spark, metric, kind):
    rng = np.random.default_rng(3)
    x = {"groups": lambda: groups(rng, 400, 12), "noise": lambda: rng.normal(size=(400, 8)), "lattice": lambda: rng.integers(0, 4, size=(400, 3))}[kind]()
    rows, df = frame(spark, x)
    got = N.nearest(df, df, 6, "id", "v", "c", metric, skip_self=True, cell_rows=50).collect()
    want = brute(rows, [r[:2] for r in rows], 6, metric, True)
    assert {(r["id"], r["rank"]): (r["ref_id"], r["label"], pytest.approx(r["distance"])) for r in got} == want


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(4)
    x = groups(rng, 200, 4)
    rows = [(i, [float(z) for z in v], i % 2) for i, v in enumerate(x)]
    rows += [(500, None, 1), (501, [float("nan"), 0.0, 0.0], 1), (502, [float("inf"), 0.0, 0.0], 1), (503, [None, 0.0, 0.0], 0)]
    rows += [(600 + i, rows[5][1], 1) for i in range(60)]  # a hot point
    df = spark.createDataFrame(rows, "id bigint, v array<double>, c int")
    got = N.nearest(df, df, 4, "id", "v", "c", skip_self=True, cell_rows=20).collect()
    fine = [r for r in rows if r[0] < 500 or r[0] >= 600]
    want = brute(fine, [r[:2] for r in fine], 4, "euclidean", True)
    assert {(r["id"], r["rank"]): (r["ref_id"], r["label"]) for r in got} == {k: v[:2] for k, v in want.items()}
    few = N.nearest(df, df.limit(0), 4, "id", "v", "c", cell_rows=20)
    assert few.count() == 0 and N.nearest(df.limit(0), df, 4, "id", "v", "c", cell_rows=20).count() == 0


def test_fewer_references_than_asked_for(spark):
    _, df = frame(spark, np.arange(12.0).reshape(12, 1))
    got = N.nearest(df, df, 20, "id", "v", "c", skip_self=True, cell_rows=3).collect()
    assert len(got) == 12 * 11 and [r["ref_id"] for r in got if r["id"] == 0] == list(range(1, 12))


def test_blocks_of_many_rows_and_queries_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 16)
    rng = np.random.default_rng(6)
    rows, df = frame(spark, np.concatenate([np.zeros((150, 2)), rng.normal(size=(150, 2))]))
    got = N.nearest(df, df, 3, "id", "v", "c", cell_rows=64).collect()
    want = brute(rows, [r[:2] for r in rows], 3, "euclidean", False)
    assert {(r["id"], r["rank"]): r["ref_id"] for r in got} == {k: v[0] for k, v in want.items()}


def test_work_grows_with_the_table_not_its_square(spark):
    """Eight times the rows of grouped data: about eight times the distances, where all pairs would be 64 times."""
    compared = {}
    for n in (500, 4_000):
        rng = np.random.default_rng(8)
        _, df = frame(spark, groups(rng, n, n // 50))
        refs = df.select("id", df["v"].alias("vec"), df["c"].alias("label"))
        index = M.MetricIndex(refs, n, "euclidean", 50)
        assert index.nearest(refs.select("id", "vec"), 5, skip_self=True).count() == 5 * n
        compared[n] = index.compared
    assert compared[4_000] < 16 * compared[500] and compared[4_000] < 0.1 * 4_000**2


def test_bounds_hold(spark):
    rng = np.random.default_rng(7)
    _, df = frame(spark, rng.normal(size=(400, 4)))
    refs = df.select("id", df["v"].alias("vec"), df["c"].alias("label"))
    index = M.MetricIndex(refs, 400, "euclidean", 30)
    held = index.rows.collect()
    assert len(held) == 400 and index.blocks.rows.sum() == 400
    q = rng.normal(size=(20, 4)) * 2
    bounds = index.blocks.bounds(q)
    at = {b: i for i, b in enumerate(index.blocks.number.tolist())}
    for r in held:
        d = np.sqrt(((q - np.array(r["vec"])) ** 2).sum(axis=1))
        assert (bounds[:, at[r["block"]]] <= d).all()


def test_rows_of_few_columns_meet_few_cells(spark):
    """Points without groups in three columns, and a lattice of many equal rows: a query meets some 2 % of the rows."""
    rng = np.random.default_rng(9)
    for x, share in ((rng.random((3_000, 3)), 0.1), (rng.integers(0, 6, size=(3_000, 3)).astype(float), 0.03)):
        _, df = frame(spark, x)
        refs = df.select("id", df["v"].alias("vec"), df["c"].alias("label"))
        index = M.MetricIndex(refs, len(x), "euclidean", 20)
        assert index.nearest(refs.select("id", "vec"), 3, skip_self=True).count() == 3 * len(x)
        assert not index.gridded and index.compared < share * len(x) ** 2


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("skip_self", [True, False])
def test_rows_of_equal_vectors_and_ids(metric, skip_self):
    """Ids that repeat, null ids, equal vectors and offsets that single precision cannot hold."""
    rng = np.random.default_rng(10)
    for offset in (0.0, 3e9, 1e20):
        b = rng.integers(0, 3, size=(300, 2)) * 1.5 + offset
        ids = pd.Series(rng.integers(0, 60, size=300).astype(float)).where(rng.random(300) > 0.05)
        a, own = b[:80], ids[:80]
        a_ids, b_ids = M.id_codes(own, ids)
        i, j, d = M.nearest_rows(a, a_ids, b, b_ids, 4, metric, skip_self)
        for q in range(80):
            gaps = M.exact_distance(a[[q]], b, metric)
            far = [(gaps[r], ids[r] if ids[r] == ids[r] else np.inf) for r in range(300) if not (skip_self and own[q] == ids[r])]
            got = [(x, ids[r] if ids[r] == ids[r] else np.inf) for x, r in zip(d[i == q], j[i == q])]
            assert got == sorted(far)[:4]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_grid_where_nothing_can_be_left_out(spark, monkeypatch, metric):
    monkeypatch.setattr(M, "CELL_ROWS", 40)
    monkeypatch.setattr(M, "PART_ROWS", 40)
    monkeypatch.setattr(M, "TILE", (16, 32))
    rng = np.random.default_rng(11)
    rows, df = frame(spark, rng.normal(size=(700, 30)))
    refs = df.select("id", df["v"].alias("vec"), df["c"].alias("label"))
    index = M.MetricIndex(refs, 700, metric, 20)
    got = index.nearest(refs.select("id", "vec"), 5, skip_self=True).collect()
    assert index.gridded
    want = brute(rows, [r[:2] for r in rows], 5, metric, True)
    assert {(r["id"], r["rank"]): (r["ref_id"], r["label"], pytest.approx(r["distance"])) for r in got} == want


def test_rows_moved_by_a_grid_follow_the_table():
    assert [M.grid_parts(n, 64) for n in (1_000, 100_000, 600_000, 1_000_000)] == [1, 8, 8, 8]
    # Beyond the memory of a part there are more of them.
    assert M.grid_parts(4_000_000, 64) == 31


def test_blocks_of_all_pairs_stay_few(spark, monkeypatch):
    """The number of blocks, and with it the copies of a row, is fixed until memory asks for more; sums are those of all pairs."""
    monkeypatch.setattr(M, "CELL_ROWS", 10)
    monkeypatch.setattr(N, "TILE", (7, 11))
    rng = np.random.default_rng(12)
    x = rng.normal(size=(400, 3))
    for n in (200, 400):
        _, df = frame(spark, x[:n])
        ids = df.select("id", df["v"].alias("vec"))
        met = N.block_pairs(ids, ids, lambda q, r: pd.DataFrame({"q": [len(q)], "r": [len(r)]}), "q long, r long", None)
        assert met.count() == M.GRID**2 and met.selectExpr("sum(q * r)").first()[0] == n * n
        got = {(r["id"], r["cluster"]): r["total"] for r in N.cluster_distances(df, "id", "v", "c").collect()}
        d = np.sqrt(((x[:n, None] - x[None, :n]) ** 2).sum(axis=2))
        assert got == {(i, c): pytest.approx(d[i, np.arange(n) % 3 == c].sum()) for i in range(n) for c in range(3)}


@pytest.mark.parametrize("kind, metric, cell_rows", [("groups", "euclidean", 40), ("noise", "manhattan", 40), ("lattice", "manhattan", 1_000)])
def test_rows_of_one_fold_do_not_meet(spark, kind, metric, cell_rows):
    rng = np.random.default_rng(9)
    x = {"groups": lambda: groups(rng, 300, 9), "noise": lambda: rng.normal(size=(300, 8)), "lattice": lambda: rng.integers(0, 3, size=(300, 3))}[kind]()
    rows, df = frame(spark, x)
    folds = df.selectExpr("*", "nullif(id % 4, 3) AS fold")
    got = N.nearest(folds, folds, 5, "id", "v", "c", metric, cell_rows=cell_rows, apart="fold").collect()
    fold = {i: i % 4 if i % 4 < 3 else None for i, _, _ in rows}
    want = {}
    for i, v, _ in rows:
        want |= brute([r for r in rows if fold[i] is None or fold[r[0]] != fold[i]], [(i, v)], 5, metric, False)
    assert {(r["id"], r["rank"]): (r["ref_id"], r["label"], pytest.approx(r["distance"])) for r in got} == want


def test_a_grid_of_settings_searches_once_per_metric(spark, monkeypatch):
    """All folds meet in one search; one for each fold would index the others' rows as often as there are folds."""
    built = []
    start = M.MetricIndex.__init__
    monkeypatch.setattr(M.MetricIndex, "__init__", lambda self, refs, n, metric, cell_rows: (built.append((n, metric)), start(self, refs, n, metric, 50))[1])
    n = N.CELL_ROWS + 400
    rows, df = frame(spark, groups(np.random.default_rng(10), n, 30))
    got = Z.knn_grid(df.selectExpr("*", "id % 5 AS fold"), "id", "v", "c", ks=(3,), weights=("uniform",), fold="fold").collect()
    assert sorted(built) == [(n, "euclidean"), (n, "manhattan")] and len(got) == 2
    x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    hits = []
    for i in range(n):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i % 5 :: 5] = np.inf
        hits.append(np.bincount(c[np.argsort(d, kind="stable")[:3]]).argmax() == c[i])
    mean = np.mean([np.mean(hits[f::5]) for f in range(5)])
    assert {r["metric"]: r["cv_accuracy_mean"] for r in got}["euclidean"] == pytest.approx(mean)
