import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.operators import sampling as S
from chartmill.operators.rows import exclude_values, keep_labelled, normalise_names
from chartmill.sources import tables as R

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,2.5,None\n?,x, keep \n3,,"a, ""b"""\n4,NaN,N/A\n')
    return str(path)


def test_default_tokens(spark, csv):
    got = [tuple(r) for r in R.read_table_csv(spark, csv, SCHEMA, ["?"]).collect()]
    assert got == [(1, 2.5, None), (None, None, " keep "), (3, None, 'a, "b"'), (4, None, None)]


def test_only_empty_is_missing(spark, csv):
    got = [r["c"] for r in R.read_table_csv(spark, csv, SCHEMA, [""], keep_default_na=False).collect()]
    assert got == ["None", " keep ", 'a, "b"', "N/A"]
    none = R.read_table_csv(spark, csv, keep_default_na=False)
    assert [r["b"] for r in none.collect()] == ["2.5", "x", "", "NaN"]


def test_broken_write_is_no_cache(spark, tmp_path):
    path = tmp_path / "cache"
    path.mkdir()
    (path / "part-0.parquet").write_text("half")
    build = lambda: spark.range(3)
    assert R.cached_table(spark, str(path), build).count() == 3
    assert R.cached_table(spark, str(path), lambda: spark.range(9)).count() == 3
    assert R.cached_table(spark, str(path), lambda: spark.range(9), force=True).count() == 9


def test_versions_go_by_number(spark, tmp_path):
    base = str(tmp_path / "v")
    numbers = [R.write_versioned(spark.range(n), base) for n in range(1, 12)]
    assert numbers == list(range(1, 12)) == R.versions(spark, base)
    assert R.latest_version(spark, base).count() == 11
    (tmp_path / "v" / "version=40").mkdir()
    assert R.latest_version(spark, base).count() == 11 and R.write_versioned(spark.range(1), base) == 41


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, 'x "y", z'), (2, None, None)], SCHEMA)
    R.write_table(df, str(tmp_path / "o"), fmt="csv")
    assert sorted(tuple(r) for r in R.read_table_csv(spark, str(tmp_path / "o"), SCHEMA).collect())[0] == (1, 0.1, 'x "y", z')


def test_names(spark):
    with pytest.raises(ValueError):
        normalise_names(spark.range(1).select(F.col("id").alias("A "), F.col("id").alias(" a")))


def test_null_safe_filters(table):
    df = table([("x",), ("UNKNOWN",), (None,)], "l string")
    assert [r[0] for r in keep_labelled(df, "l").collect()] == ["x", None]
    assert [r[0] for r in exclude_values(df, "l", ["x"]).collect()] == ["UNKNOWN", None]


def test_folds_inside_a_split_are_even(spark):
    df = spark.range(20000).withColumn("y", F.col("id") % 5)
    train = S.stratified_split(df, "y", [0.6, 0.4], "id").where("split = 0").drop("split")
    folds = {r["fold"]: r["count"] for r in S.kfold_assign(train, "y", 5, "id").groupBy("fold").count().collect()}
    assert set(folds) == set(range(5)) and max(folds.values()) - min(folds.values()) < 300
    assert S.bootstrap(train, 4000, "id").count() == 4000


def test_bootstrap_draws_exactly(spark):
    df = spark.range(500)
    for n in (0, 5, 1000, 100_000):
        drawn = S.bootstrap(df, n, "id")
        counts = {r["id"]: r["count"] for r in drawn.groupBy("id").count().collect()}
        assert sum(counts.values()) == n and set(counts) <= set(range(500))
        if n == 100_000:
            off = sum((counts[i] - 200) ** 2 / 200 for i in range(500))
            assert 350 < off < 650  # 499 degrees of freedom
    assert S.bootstrap(df, 50_000, "id", cap=2).count() == 1000
    assert S.bootstrap(df.where("id < 0"), 10, "id").count() == 0
    assert sorted(S.bootstrap(df, 700, "id").collect()) == sorted(S.bootstrap(df.repartition(3), 700, "id").collect())
    assert sorted(S.bootstrap(df, 700, "id").collect()) != sorted(S.bootstrap(df, 700, "id", seed=1).collect())


def test_bootstrap_of_repeated_rows_and_null_keys(table):
    df = table([(7, "x")] * 300 + [(7, "y")] * 100 + [(None, "z")] * 200, "k long, v string")
    for keys in ("k", ["k", "v"]):
        drawn = {r["v"]: r["count"] for r in S.bootstrap(df, 6000, keys).groupBy("v").count().collect()}
        assert sum(drawn.values()) == 6000
        assert abs(drawn["x"] - 3000) < 250 and abs(drawn["y"] - 1000) < 180 and abs(drawn["z"] - 2000) < 220


def test_sample_of_repeated_keys(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    for n in (0, 1, 100, 143, 999, 1000, 5000):
        assert S.sample_rows(df, n, "k").count() == min(n, 1000)
    plan = S.sample_rows(spark.range(1000), 100, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_exact_split_moves_no_row(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("y"), F.lit("wide").alias("w"))
    for parts in (S.stratified_split(df, "y", [0.7, 0.3], "id", exact=True), S.kfold_assign(df, "y", 4, "id", exact=True)):
        plan = parts._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_exact_split_with_missing_labels(table):
    df = table([(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(400)], "id int, y string")
    got = {(r["y"], r["split"]): r["count"] for r in S.stratified_split(df, "y", [0.6, 0.2, 0.2], "id", exact=True).groupBy("y", "split").count().collect()}
    assert got == {(None, 0): 60, (None, 1): 20, (None, 2): 20, ("a", 0): 60, ("a", 1): 20, ("a", 2): 20, ("b", 0): 120, ("b", 1): 40, ("b", 2): 40}


def test_split_needs_no_exchange(spark):
    df = S.stratified_split(spark.range(100).withColumn("y", F.lit(1)), "y", [0.8, 0.2], "id")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_each_time(spark):
    df = spark.range(1000)
    a, b = ({r[0] for r in S.sample_rows(df.repartition(n), 50, "id").collect()} for n in (3, 11))
    assert a == b and len(a) == 50 and a != {r[0] for r in S.sample_rows(df, 50, "id", seed=1).collect()}


def test_row_steps_run_on_a_stream(spark, tmp_path):
    from chartmill.functions import equals, recode

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, l string").write.parquet(source)
    stream = spark.readStream.schema("id int, l string").parquet(source)
    out = exclude_values(stream, "l", ["x"]).select("id", equals("l", "y").alias("is_y"), recode("l", {"y": 7}, 0).alias("code"))
    query = out.writeStream.format("memory").queryName("steps").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(tuple(r) for r in spark.table("steps").collect()) == [(2, 1, 7), (3, 0, 0)]
