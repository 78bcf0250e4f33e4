"""Run a query in Spark and its SQL in DuckDB and compare rows, names, types and values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else "") for v in row)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when the two agree exactly."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    faults = []
    spark_names = spark_df.columns
    if sorted(names) != sorted(spark_names):
        return [f"columns {sorted(spark_names)} expected {sorted(names)}"]
    for name, kind in zip(names, kinds):
        got = spark_df.schema[name].dataType.simpleString()
        if TYPES.get(kind, kind) != got:
            faults.append(f"type of {name}: {got}, expected {kind}")
    order = sorted(names)
    left = sorted((tuple(_plain(r[c]) for c in order) for r in spark_df.collect()), key=_key)
    at = [names.index(c) for c in order]
    right = sorted((tuple(_plain(r[i]) for i in at) for r in expected), key=_key)
    if len(left) != len(right):
        faults.append(f"{len(left)} rows, expected {len(right)}")
    for a, b in zip(left, right):
        if a != b:
            faults.append(f"{dict(zip(order, a))} expected {dict(zip(order, b))}")
            if len(faults) > 4:
                break
    return faults
