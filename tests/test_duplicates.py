import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chartmill.operators import duplicates as D


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    # One key holds a third of all rows, some of them equal throughout; keys may be missing.
    return [
        ("hot" if i % 3 == 0 else rng.choice([None, f"k{rng.randint(0, 200)}"]), rng.randint(0, 5), i if i % 2 else 0)
        for i in range(1200)
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, n int")


@pytest.mark.parametrize("chunk", [3, 100_000])
@pytest.mark.parametrize("subset", [None, ["k"], ["k", "v"]])
def test_report(df, rows, subset, chunk, monkeypatch):
    monkeypatch.setattr(D, "_CHUNK", chunk)
    at = [0, 1, 2] if subset is None else ["kvn".index(c) for c in subset]
    sizes = Counter(tuple(r[i] for i in at) for r in rows)
    expected = [(*r, sizes[tuple(r[i] for i in at)]) for r in rows if sizes[tuple(r[i] for i in at)] > 1]
    got = [tuple(r) for r in D.duplicate_report(df, subset).collect()]
    assert Counter(got) == Counter(expected)
    keys = [tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r[:3]) for r in got]
    assert keys == sorted(keys)


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_drop_by_key(df, rows, keep):
    unique = [r for r in rows if r[2]]
    small = df.where("n > 0")
    got = Counter(tuple(r) for r in D.drop_duplicate_rows(small, ["k"], keep, "n").collect())
    sizes = Counter(r[0] for r in unique)
    if keep is False:
        expected = [r for r in unique if sizes[r[0]] == 1]
    else:
        pick = min if keep == "first" else max
        expected = [pick((r for r in unique if r[0] == k), key=lambda r: r[2]) for k in sizes]
    assert got == Counter(expected)


def test_whole_rows(df, rows):
    assert D.drop_duplicate_rows(df).count() == len(set(rows))
    alone = [r for r, n in Counter(rows).items() if n == 1]
    assert D.drop_duplicate_rows(df, keep=False).count() == len(alone)


def test_surplus(df, rows):
    got = D.count_surplus(df, "k").first()
    assert (got["rows"], got["groups"], got["surplus"]) == (1200, len({r[0] for r in rows}), 1200 - len({r[0] for r in rows}))


def test_order_is_required(df):
    with pytest.raises(ValueError):
        D.drop_duplicate_rows(df, ["k"])


def test_first_per_key_reduces_before_its_one_exchange(df):
    plan = D.first_per_key(df, "k", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    partial = plan.index("Partial")
    assert partial > plan.index("Exchange"), "the map side keeps one row per key"


def test_report_moves_rows_once_before_its_sort(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("k"), F.lit("wide").alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.duplicate_report(df, ["k"], sort=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3, "the rows, the counts by key, and these again"


def test_distinct_long_values(table):
    from chartmill.operators.profiling import count_distinct

    df = table([("a" * 5000,), ("a" * 5000,), ("b",), (None,), ("",)], "t string")
    assert count_distinct(df, "t").first()[0] == 3
