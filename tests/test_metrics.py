from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chartmill.operators import metrics as L
from chartmill.sources.tables import read_table_csv

# The saved scores whose metrics are known.
GOLDEN = str(Path(__file__).parent / "data" / "golden_scores.csv")


@pytest.fixture(scope="module")
def golden(spark):
    text = read_table_csv(spark, GOLDEN)
    return text.select(*[F.col(c).cast("int").alias(c) for c in ("y", "y_pred")], F.col("p1").cast("double").alias("p1")).cache()


def test_golden_metrics(golden):
    got = L.binary_metrics(golden, "y", "p1", "y_pred").first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (21, 6, 13, 12)
    expected = dict(
        accuracy=0.6346153846, roc_auc=0.6088888889, average_precision=0.6198931470, precision_0=0.6176470588,
        recall_0=0.7777777778, precision_1=0.6666666667, recall_1=0.48, mean_confidence=0.5911175514, mean_score=0.4745277890,
    )
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-9), name
    assert L.binary_metrics(golden, "y", "p1").first() == got


def test_golden_curve(golden):
    points = L.roc_curve(golden, "y", "p1").collect()
    assert len(points) == 53
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0) and (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert [p["tpr"] for p in points] == sorted(p["tpr"] for p in points)
    corners = L.roc_curve(golden, "y", "p1", drop_intermediate=True).collect()
    assert len(corners) == 28
    assert {(p["fpr"], p["tpr"]) for p in corners} <= {(p["fpr"], p["tpr"]) for p in points}


def test_golden_threshold_and_capture(golden):
    best = L.best_observed_threshold(golden, "y", "p1").first()
    assert best["f1"] == pytest.approx(0.6944444444) and best["threshold"] == pytest.approx(0.3386533539)
    top = L.capture_at(golden, "y", "p1", 0.2).first()
    assert (top["rows_selected"], top["positives_selected"], top["positives"]) == (10, 6, 25)


def test_metrics_per_group(golden):
    both = golden.withColumn("g", F.lit("a")).unionByName(golden.where("y_pred = 1").withColumn("g", F.lit("b")))
    got = {r["g"]: r for r in L.binary_metrics(both, "y", "p1", by=["g"]).collect()}
    assert got["a"]["roc_auc"] == pytest.approx(0.6088888889)
    assert (got["b"]["tp"], got["b"]["fp"]) == (12, 6)


def test_known_confusion(table):
    m = table([(9210, 3619, 634, 625, 0.1739), (0, 0, 0, 0, 0.0)], "tn int, fp int, fn int, tp int, average_precision double")
    rows = L.f1_from_confusion(m).orderBy(F.desc("tn")).collect()
    assert rows[0]["f1_minority"] == 0.2271 and rows[1]["f1_macro"] == 0.0
    report = L.with_class_report(m).orderBy(F.desc("tn")).first()
    assert (round(report["precision_1"], 4), round(report["recall_1"], 4)) == (0.1473, 0.4964)
    balance = L.class_balance(m).orderBy(F.desc("tn")).first()
    assert (balance["majority_pct"], balance["minority_pct"], balance["minority_weight"]) == (91.1, 8.9, 10.2)


def test_single_class(table):
    one = L.binary_metrics(table([(1, 0.3), (1, 0.9)], "y int, s double"), "y", "s").first()
    assert one["roc_auc"] is None and one["average_precision"] == 1.0 and one["precision_0"] == 0.0


def test_rows_without_score_are_left_out(table):
    df = table([(1, 0.9), (0, 0.1), (None, 0.4), (1, None)], "y int, s double")
    assert L.binary_metrics(df, "y", "s").first()["n"] == 2


def test_threshold_grid_matches_plain_search(table):
    import numpy as np

    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 400), rng.random(400).round(3)
    # Some scores lie exactly on the grid.
    s[:40] = (0.05 + np.arange(40) * ((0.95 - 0.05) / 299))
    got = L.best_threshold(table([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double"), "y", "s").first()
    grid = [0.05 + i * ((0.95 - 0.05) / 299) for i in range(300)]
    f1 = [2 * ((s >= t) & (y == 1)).sum() / ((s >= t).sum() + y.sum()) for t in grid]
    assert got["f1"] == pytest.approx(max(f1)) and got["threshold"] == pytest.approx(grid[int(np.argmax(f1))])


@pytest.mark.parametrize("slice_rows, sorted_rows", [(1 << 19, 1 << 18), (40, 64)])
def test_scores_beside_each_other_have_the_metrics_of_each(spark, monkeypatch, slice_rows, sorted_rows):
    """Ties, missing and odd numbers, in one slice and in several."""
    monkeypatch.setattr(L, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(L, "SORTED", sorted_rows)
    rows = spark.range(3_000, numPartitions=5).selectExpr(
        "CAST(id % 3 AS INT) AS fold", "IF(id % 41 = 0, NULL, CAST(id * 7919 % 1000 < 300 + id % 500 AS INT)) AS y",
        "pmod(xxhash64(id), 100003) / 100003D AS fine", "IF(id % 50 = 1, NULL, id % 7 / 7D) AS tied", "CASE id % 90 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN -0D WHEN 2 THEN 0D ELSE id % 500 / 500D END AS odd",
    )
    names = ["fine", "tied", "odd"]
    rows = rows.selectExpr("*", *[f"CAST(IF({n} = 0.5, NULL, {n} > 0.4) AS INT) AS c_{n}" for n in names]).cache()
    share = L.draw_share(3_000)
    assert (share > 0) == (slice_rows == 40)
    drawn = rows.sample(share, 1) if share else None
    got = L.area_per_score(rows, "y", {n: (n, f"c_{n}") for n in names}, "fold", 3_000, drawn).collect()
    want = {(n, r["fold"]): r for n in names for r in L.binary_metrics(rows, "y", n, f"c_{n}", by=["fold"]).collect()}
    assert {(r["_name"], r["fold"]) for r in got} == set(want) and len(got) == 9
    for r in got:
        assert r["accuracy"] == pytest.approx(want[r["_name"], r["fold"]]["accuracy"], abs=1e-12)
        assert r["roc_auc"] == pytest.approx(want[r["_name"], r["fold"]]["roc_auc"], abs=1e-12)
