"""Imputation and scaling read their source twice at most."""

import numpy as np
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from chartmill.catalog import catalog
from chartmill.operators import clusters as K
from chartmill.operators import missing as M

ROWS = [
    (1.0, 4, "b", 2.0, None, True),
    (float("nan"), None, "a", None, "x", None),
    (3.0, 4, "a", 5.0, None, True),
    (None, 7, None, float("nan"), "y", False),
    (10.0, 9, "b", 6.0, None, None),
]
SCHEMA = "m double, i int, s string, h double, t string, f boolean"


def test_all_strategies_from_one_table(table):
    df = table(ROWS, SCHEMA)
    plan = {"m": "median", "i": "mode", "s": "mode", "h": "mean", "t": ("constant", "-"), "f": "mode"}
    got = [tuple(r) for r in M.impute(df, plan).collect()]
    mean = (2.0 + 5.0 + 6.0) / 3
    assert got == [
        (1.0, 4, "b", 2.0, "-", True),
        (3.0, 4, "a", pytest.approx(mean), "x", True),
        (3.0, 4, "a", 5.0, "-", True),
        (3.0, 7, "a", pytest.approx(mean), "y", False),
        (10.0, 9, "b", 6.0, "-", True),
    ]
    assert M.impute(df, plan).schema["i"].dataType.simpleString() == "int"
    rough = [tuple(r) for r in M.impute(df, plan, accuracy=1000).collect()]
    assert rough == got


def test_nothing_known_stays_missing(table):
    df = table([(None, None), (None, None)], "a double, b string")
    assert [tuple(r) for r in M.impute(df, {"a": "median", "b": "mode"}).collect()] == [(None, None)] * 2
    assert M.impute(df.limit(0), {"a": "median", "b": "mode"}).count() == 0
    assert [tuple(r) for r in M.impute(df, {"a": "mean"}).collect()] == [(None, None)] * 2


def test_scaled_inputs(table):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=40), rng.exponential(size=40)
    rows = [(float(x) if i % 5 else None, float(y) if i % 7 else float("nan"), 2.0) for i, (x, y) in enumerate(zip(a, b))]
    got = K.cluster_features(table(rows, "a double, b double, c double"), ["a", "b", "c"], log_cols=["b"], vector=None)
    full = [[v if v is not None and v == v else np.nan for v in r] for r in rows]
    x = np.array(full)
    x = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    x[:, 1] = np.log1p(x[:, 1])
    spread = x.std(axis=0)
    want = (x - x.mean(axis=0)) / np.where(spread == 0, 1, spread)
    out = np.array([[r["a_z"], r["b_z"], r["c_z"]] for r in got.collect()])
    assert np.sort(out, axis=0) == pytest.approx(np.sort(want, axis=0))


def source_scans(spark, run):
    """File scans of the given tables in all jobs that a query starts, from what each plan read."""
    import chartmill.operators.stages as S

    plans, own = [], S.written
    modules = [m for m in (M, K) if hasattr(m, "written")]

    def told(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    for m in modules:
        m.written = told
    try:
        df = run(spark, TINY)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    finally:
        for m in modules:
            m.written = own
    return sum(line.count("FileScan") for p in plans for line in p.splitlines() if TINY in line)


@pytest.mark.parametrize("name", ["impute_by_strategy", "clinical_table", "scaled_cluster_inputs", "fill_with_medians"])
def test_two_scans_of_the_source(spark, name):
    assert source_scans(spark, catalog()[name].run) <= 2


def test_running_totals_read_the_source_once(spark):
    """Edges, slice totals and values share one exchange, so the source is scanned once."""
    from chartmill.operators.ordered import running_totals

    counts = spark.read.parquet(f"{TINY}/lineitem.parquet").groupBy("l_extendedprice").agg(F.count("*").alias("n"), F.sum("l_tax").alias("w"))
    df = running_totals(counts, "l_extendedprice", ["n", "w"])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffled = [line for line in final.splitlines() if "FileScan" in line]
    assert len(shuffled) == 1 and "ReusedExchange" in final
