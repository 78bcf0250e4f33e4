"""Every registered query, run once: against its SQL where it has one, and for what its plan must not contain."""

import pytest
from conftest import TINY
from oracle import compare, connect

import __spark_entry__ as entry_points
from chartmill.catalog import catalog

QUERIES = catalog()

# Matrix work on blocks of vectors runs in Arrow-fed tasks; everything else stays in the engine.
BLOCKS = {
    "nearest_vectors",
    "nearest_parts",
    "neighbour_vote_by_distance",
    "neighbour_vote_uniform_manhattan",
    "neighbour_settings",
    "vote_of_models",
    "silhouette_of_labels",
    "davies_bouldin_of_labels",
}


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query = QUERIES[name]
    df = query.run(spark, TINY)
    if query.sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, query.sql) == []
    # After the run this is the final plan of the adaptive engine.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert name in BLOCKS or "Pandas" not in plan


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    rows = {r["o_orderpriority"]: (round(r["rate"], 6), r["n"]) for r in entry_points.entry(spark).collect()}
    assert rows == {
        "1-URGENT": (0.193548, 31),
        "2-HIGH": (0.333333, 39),
        "3-MEDIUM": (0.409091, 44),
        "4-NOT SPECIFIED": (0.277778, 36),
    }
