"""Merged states of versions against profiles of the whole table."""

import pytest
from conftest import TINY
from pyspark.sql import functions as F

from chartmill.operators.missing import cleaning_summary
from chartmill.operators.profiling import cleaning_stats, describe
from chartmill.sources import profiles as V
from chartmill.sources.tables import versions

RULES = {"large": "x > 50", "named": "word IS NOT NULL"}


@pytest.fixture
def grown(spark, tmp_path):
    """A table in three versions, one of them empty, with missing values, NaN, a large offset and repeated rows."""
    rows = spark.range(3_000).select(
        (F.col("id") % 97).cast("int").alias("x"),
        (F.lit(1e9) + F.when(F.col("id") % 11 > 0, F.col("id") % 13)).alias("offset"),
        F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id") / 3).alias("real"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("w"), F.col("id") % 40)).alias("word"),
        F.lit(None).cast("double").alias("nothing"),
    )
    base = str(tmp_path / "grown")
    V.append_version(rows.where("x < 30"), base, RULES)
    V.append_version(rows.where("false"), base, RULES)
    V.append_version(rows.where("x >= 30"), base, RULES)
    return base, rows


def test_merged_profile_is_that_of_the_whole(spark, grown):
    base, rows = grown
    got = {r["column"]: r for r in V.profile_of_states(V.version_states(spark, base, RULES)).collect()}
    for want in describe(rows).collect():
        r = got.pop(want["column"])
        assert (r["rows"], r["missing"], r["min"], r["max"]) == (want["rows"], want["missing"], want["min"], want["max"])
        for c in ("mean", "std"):
            assert r[c] == (want[c] if want[c] is None else pytest.approx(want[c], rel=1e-9))
        assert (r["p50"] is None) == (want["p50"] is None)
    assert not got


def test_sketches_keep_their_error(spark, tmp_path):
    base, n = str(tmp_path / "wide"), 400_000
    for i in range(4):
        V.append_version(spark.range(n).where(F.col("id") % 4 == i).select("id", F.col("id").cast("string").alias("t")), base)
    got = {r["column"]: r for r in V.profile_of_states(V.version_states(spark, base), (0.01, 0.5, 0.99)).collect()}
    for c in ("id", "t"):
        assert abs(got[c]["n_distinct"] / n - 1) < 0.03
    for p, at in ((1, 0.01), (50, 0.5), (99, 0.99)):
        assert abs(got["id"][f"p{p}"] / n - at) < 0.008
    assert got["t"]["p50"] is None


def test_conditions_and_summaries(spark, grown):
    base, rows = grown
    states = V.version_states(spark, base, RULES)
    want = {name: rows.where(rule).count() for name, rule in RULES.items()}
    assert {r["condition"]: r["n"] for r in V.condition_counts(states).collect()} == want

    kept = str(base) + "-kept"
    cleaned = rows.where("word IS NOT NULL").withColumn("y", (F.col("x") > 50).cast("int"))
    rules = {"one": "y = 1", "zero": "y = 0"}
    for part in ("x < 10", "x >= 10"):
        V.append_version(cleaned.where(part), kept, rules)
    after = V.version_states(spark, kept, rules)
    assert V.cleaning_stats_of_states(states, after, 5, "one", "zero").collect() == cleaning_stats(rows, cleaned, "y", 5).collect()
    merged = V.cleaning_summary_of_states(states, after).orderBy("column")
    assert merged.collect() == cleaning_summary(rows, cleaned).select(*merged.columns).orderBy("column").collect()


def test_old_versions_are_not_read_again(spark, grown):
    base, rows = grown
    files = V.version_states(spark, base, RULES).inputFiles()
    assert files and all("/_profiles/" in f for f in files)
    # With other conditions each version is read once, and its state kept.
    other = {"small": "x < 5"}
    assert [r["n"] for r in V.condition_counts(V.version_states(spark, base, other)).collect()] == [rows.where("x < 5").count()]
    assert versions(spark, base) == [1, 2, 3]
    early = V.profile_of_states(V.version_states(spark, base, RULES, as_of=2)).where("column = 'x'").first()
    assert early["rows"] == rows.where("x < 30").count() and early["max"] == 29


def test_lost_state_comes_back(spark, grown):
    base, rows = grown
    folder = V._states_folder(base, RULES)
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{folder}/version=3/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    got = V.profile_of_states(V.version_states(spark, base, RULES)).where("column = 'x'").first()
    assert got["rows"] == rows.count()


def test_columns_that_come_and_go(spark, tmp_path):
    base = str(tmp_path / "changing")
    V.append_version(spark.range(10).select(F.col("id").alias("a"), F.lit("s").alias("b")), base)
    V.append_version(spark.range(6).select(F.col("id").alias("a"), F.lit(2.5).alias("name"), F.lit(1).alias("rows")), base)
    got = {r["column"]: (r["rows"], r["missing"], r["n_distinct"], r["mean"]) for r in V.profile_of_states(V.version_states(spark, base)).collect()}
    assert got == {"a": (16, 0, 10, 3.75), "b": (16, 6, 1, None), "name": (16, 10, 1, 2.5), "rows": (16, 10, 1, 1.0)}


def test_empty_and_missing_tables(spark, tmp_path):
    base = str(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        V.version_states(spark, base)
    V.append_version(spark.read.parquet(f"{TINY}/orders.parquet").where("false").select("o_orderkey", "o_orderstatus"), base)
    rows = V.profile_of_states(V.version_states(spark, base)).orderBy("column").collect()
    assert [(r["rows"], r["missing"], r["missing_pct"], r["n_distinct"], r["std"]) for r in rows] == [(0, 0, None, 0, None)] * 2
