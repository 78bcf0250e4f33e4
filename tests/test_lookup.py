"""Values per key, met by keys that hold much of the table."""

import pytest
from pyspark.sql import functions as F

from chartmill.operators.lookup import attach, shares

SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24"}


@pytest.fixture
def plain(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_with_a_hot_key(spark, hot):
    return spark.range(30_000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), "id"))).repartition(6)


@pytest.mark.parametrize("hot", ["hot", None])
def test_a_key_with_a_third_of_the_rows_meets_its_value_in_a_third_of_the_tasks(plain, hot):
    df = rows_with_a_hot_key(plain, hot)
    table = df.groupBy("k").agg(F.count("*").alias("n"))
    met = attach(df, "k", table, "k", "n", "n", few=5).withColumn("task", F.spark_partition_id())
    assert met.count() == 30_000 and met.where("n IS NULL").count() == 0
    loads = [r["count"] for r in met.where(F.col("k").eqNullSafe(F.lit(hot))).groupBy("task").count().collect()]
    assert sum(loads) == 10_000 and len(loads) >= 4 and max(loads) <= 4_000
    assert {r["n"] for r in met.where(F.col("k").eqNullSafe(F.lit(hot))).select("n").distinct().collect()} == {10_000}


def test_salts_follow_the_share_of_a_key(plain):
    salts = {r["_heavy"]: r["_salts"] for r in shares(rows_with_a_hot_key(plain, "hot"), F.col("k")).collect()}
    hot = plain.range(1).select(F.xxhash64(F.lit("hot")).alias("h")).first()["h"]
    assert set(salts) == {hot} and salts[hot] in (8, 9)
    assert shares(plain.range(0).select(F.col("id").alias("k")), F.col("k")).count() == 0
