"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.llm.common import dealt_again, saved


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], int(row["s"] or 0)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node with a link to another: the smallest node of its component, itself included.

    Links are undirected and may repeat; links of a node to itself count for nothing; no links give no rows.
    Each round points all greater neighbours of a node at its smallest one (large star), then all smaller
    ones (small star), until nothing changes: a number of rounds that grows with the logarithm of the longest
    path. A round groups with a partial minimum and joins it back, so a node with very many links is
    reduced inside the map tasks and split by the adaptive join. Lineage is cut after each round.
    """
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    edges = saved(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    seen = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            dealt_again(F.col("a")).alias("u"), F.least("a", "m").alias("m")
        )
        large = both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(dealt_again(F.col("a")).alias("u"), "m")
        small = large.join(least, large["a"] == least["u"])
        edges = saved(
            small.where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        now = _signature(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
