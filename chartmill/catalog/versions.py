"""Queries on profiles of versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartmill.catalog.base import Query, Tables, register, scratch
from chartmill.functions import flag
from chartmill.sources import profiles as V

CATALOG: dict[str, Query] = {}

#: Versions into which the queries cut their table.
PARTS = 4


def _appended(rows, key: str, base: str, conditions=None) -> str:
    for i in range(PARTS):
        V.append_version(rows.where(F.col(key) % PARTS == i), base, conditions)
    return base


_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]
_WORDS = ["o_orderstatus", "o_orderpriority", "gap"]


def _orders(t: Tables):
    return t.orders.select(*_NUMBERS, *_WORDS[:2], F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus")).alias("gap"))


def _profile_sql() -> str:
    columns = [
        f"""SELECT '{c}' AS "column", {v} AS as_of, count(*) AS "rows", count(*) - count({c}) AS missing,
            round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct,
            round({f"avg({c})" if c in _NUMBERS else "NULL::DOUBLE"}, 4) AS mean,
            round({f"stddev_samp({c})" if c in _NUMBERS else "NULL::DOUBLE"}, 4) AS std,
            {f"min({c})::DOUBLE" if c in _NUMBERS else "NULL::DOUBLE"} AS min,
            {f"max({c})::DOUBLE" if c in _NUMBERS else "NULL::DOUBLE"} AS max,
            {"NULL::BIGINT" if c in _NUMBERS else f"count(DISTINCT {c})"} AS levels,
            true AS distinct_close, {"true" if c in _NUMBERS else "NULL::BOOLEAN"} AS median_close
            FROM o WHERE o_orderkey % {PARTS} < {v}"""
        for c in [*_NUMBERS, *_WORDS]
        for v in (2, PARTS)
    ]
    return f"""
    WITH o AS (SELECT {", ".join([*_NUMBERS, *_WORDS[:2]])}, CASE WHEN o_custkey % 3 > 0 THEN o_orderstatus END AS gap FROM orders)
    {" UNION ALL ".join(columns)}
    """


@register(CATALOG, _profile_sql())
def profile_over_versions(t):
    """Profiles as of two versions from stored states; sketched numbers are held against a scan of the rows."""
    rows = _orders(t)
    base = _appended(rows, "o_orderkey", scratch(t.spark) + "/orders")
    out = []
    for as_of in (2, PARTS):
        got = V.profile_of_states(V.version_states(t.spark, base, as_of=as_of))
        part = rows.where(F.col("o_orderkey") % PARTS < as_of)
        halves = got.agg(F.map_from_entries(F.collect_list(F.struct("column", "p50")))).scalar()
        seen = part.withColumn("_half", halves).agg(
            *[F.count_distinct(c).alias(f"d_{c}") for c in rows.columns],
            *[F.avg(flag(F.col(c) < F.col("_half")[c])).alias(f"lo_{c}") for c in _NUMBERS],
            *[F.avg(flag(F.col(c) <= F.col("_half")[c])).alias(f"hi_{c}") for c in _NUMBERS],
        )
        real = seen.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column"),
                            F.col(f"d_{c}").alias("d"),
                            *[(F.col(f"{s}_{c}") if c in _NUMBERS else F.lit(None).cast("double")).alias(s) for s in ("lo", "hi")],
                        )
                        for c in rows.columns
                    ]
                )
            ).alias("r")
        ).select("r.*")
        out.append(
            got.join(F.broadcast(real), "column").select(
                "column",
                F.lit(as_of).alias("as_of"),
                "rows",
                "missing",
                F.round("missing_pct", 6).alias("missing_pct"),
                F.round("mean", 4).alias("mean"),
                F.round("std", 4).alias("std"),
                "min",
                "max",
                F.when(F.col("lo").isNull(), F.col("n_distinct")).alias("levels"),
                (F.abs(F.col("n_distinct") - F.col("d")) <= 0.04 * F.col("d")).alias("distinct_close"),
                ((F.col("lo") <= 0.51) & (F.col("hi") >= 0.49)).alias("median_close"),
            )
        )
    return out[0].unionByName(out[1])


@register(
    CATALOG,
    """
    WITH c AS (SELECT o_orderstatus = 'F' AS y FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT (SELECT count(*) FROM orders) AS raw_rows, count(*) AS cleaned_rows,
           (SELECT count(*) FROM orders) - count(*) AS removed_rows, CAST(67 AS INTEGER) AS features,
           count(*) FILTER (y) AS positives, count(*) FILTER (NOT y) AS negatives,
           round_even(count(*) FILTER (y) * 100.0::DOUBLE / count(*), 1) AS rate_pct
    FROM c
    """,
)
def cleaning_totals_over_versions(t):
    rules = {"returned": "o_orderstatus = 'F'", "kept": "o_orderstatus <> 'F'"}
    folder = scratch(t.spark)
    cleaned = t.orders.where("o_orderpriority <> '5-LOW'")
    raw = V.version_states(t.spark, _appended(t.orders, "o_orderkey", f"{folder}/raw"))
    kept = V.version_states(t.spark, _appended(cleaned, "o_orderkey", f"{folder}/cleaned", rules), rules)
    return V.cleaning_stats_of_states(raw, kept, 67, "returned", "kept")


def _gaps(rows):
    """Customers with gaps in two columns."""
    return rows.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


@register(
    CATALOG,
    """
    WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS c_acctbal,
                      CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment END AS c_mktsegment FROM customer),
    m AS (SELECT count(*) AS n, count(*) - count(c_acctbal) AS a, count(*) - count(c_mktsegment) AS s,
                 count(*) FILTER (c_mktsegment IS NOT NULL) AS left_rows,
                 count(*) FILTER (c_mktsegment IS NOT NULL AND c_acctbal IS NULL) AS left_a FROM b)
    SELECT 'c_custkey' AS "column", n AS rows_before, 0::BIGINT AS missing_before, CAST(3 AS INTEGER) AS columns_before,
           left_rows AS rows_after, 0::BIGINT AS missing_after, CAST(3 AS INTEGER) AS columns_after FROM m
    UNION ALL SELECT 'c_acctbal', n, a, 3, left_rows, left_a, 3 FROM m
    UNION ALL SELECT 'c_mktsegment', n, s, 3, left_rows, 0, 3 FROM m
    """,
)
def missing_over_versions(t):
    folder = scratch(t.spark)
    before = _gaps(t.customer)
    sides = [
        V.version_states(t.spark, _appended(rows, "c_custkey", f"{folder}/{name}"))
        for name, rows in (("before", before), ("after", before.where("c_mktsegment IS NOT NULL")))
    ]
    return V.cleaning_summary_of_states(*sides)
