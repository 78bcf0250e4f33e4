"""Bringing per-group values to the rows of a table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.functions import col_of


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small result table from values the driver already holds, without a Python worker."""
    fields = [part.strip().split(" ", 1) for part in _split_fields(schema)]
    entries = [
        F.struct(*[_literal(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _split_fields(schema: str) -> list[str]:
    return re.split(r",\s*(?![^<>]*>)", schema)


def _literal(v) -> Column:
    if isinstance(v, dict):
        return F.create_map(*[F.lit(x) for pair in v.items() for x in pair])
    return F.lit(list(v)) if isinstance(v, (list, tuple)) else F.lit(v)


#: Most rows of a small side that are broadcast, and most keys that are looked at for a large share of the rows.
FEW = 10_000
HEAVY = 1_000


def shares(df: DataFrame, key: Column, heavy: int = HEAVY) -> DataFrame:
    """Hash and number of salts (``_heavy``, ``_salts``) of the keys with more rows than a shuffle task has on average.

    Found in one pass by a sketch that merges; a key's salts are as many as the tasks that its share of the rows would fill.
    At most ``heavy`` rows, which the driver holds.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketch = df.select(F.xxhash64(key).alias("h")).agg(F.expr(f"approx_top_k(h, {heavy}, {10 * heavy})").alias("top"), F.count("*").alias("n")).first()
    salts = [(top["item"], -(-top["count"] * tasks // sketch["n"])) for top in sketch["top"] or []]
    return spark.createDataFrame([x for x in salts if x[1] > 1], "_heavy long, _salts long")


def attach(
    df: DataFrame, key: str, table: DataFrame, table_key: str, value: str, name: str, few: int = FEW
) -> DataFrame:
    """Add to each row the ``value`` its key has in ``table`` (null without one). Null keys match null keys.

    A table of at most ``few`` rows is read to the driver, at once, and broadcast, so no row of ``df`` moves; lower
    the number where values are large. A larger table joins by shuffle on the key and a salt: keys that hold
    much of ``df`` are counted first and spread over as many tasks as their rows would fill; others have one salt.
    """
    side = table.select(col_of(table_key).alias("_key"), col_of(value).alias(name))
    held = side.limit(few + 1).collect()
    if len(held) <= few:
        side = F.broadcast(df.sparkSession.createDataFrame(held, side.schema))
        return df.join(side, df[f"`{key}`"].eqNullSafe(side["_key"]), "left").drop("_key")
    heavy = F.broadcast(shares(df, col_of(key)))
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    rows = df.withColumn("_at", F.xxhash64(col_of(key))).join(heavy, F.col("_at") == F.col("_heavy"), "left")
    rows = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), salts)).drop("_at", "_heavy", "_salts")
    side = side.join(heavy, F.xxhash64("_key") == F.col("_heavy"), "left")
    side = side.withColumn("_of", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_heavy", "_salts")
    on = rows[f"`{key}`"].eqNullSafe(side["_key"]) & (rows["_salt"] == side["_of"])
    return rows.join(side, on, "left").drop("_key", "_salt", "_of")
