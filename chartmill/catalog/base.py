"""What the query modules share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from chartmill.operators.stages import shared_scratch


@dataclass(frozen=True)
class Query:
    """A query on the given tables, and the SQL that must give the same rows (None: not expressible)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """The parquet tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def register(catalog: dict[str, Query], sql: str | None = None):
    """Add a function of :class:`Tables` to a catalog under its own name."""

    def add(fn):
        name = fn.__name__
        if name in catalog:
            raise ValueError(f"query {name} exists")
        catalog[name] = Query(lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return add


#: A folder for the queries that write tables.
scratch = shared_scratch
