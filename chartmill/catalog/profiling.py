"""Queries on counts, rates, distributions, group profiles and small rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartmill.catalog.base import Query, register
from chartmill.catalog.rows import ORDERS_VIEW, holed_orders
from chartmill.functions import flag
from chartmill.operators import profiling as P
from chartmill.operators.encode import map_values
from chartmill.operators.ordered import percentiles

CATALOG: dict[str, Query] = {}

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "9-NEVER", "5-LOW"]
_LEVELS = """l AS (SELECT unnest([{'position': 0, 'level': '1-URGENT'}, {'position': 1, 'level': '2-HIGH'},
    {'position': 2, 'level': '3-MEDIUM'}, {'position': 3, 'level': '9-NEVER'}, {'position': 4, 'level': '5-LOW'}]) AS e)"""
_RATED = """WITH y AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)"""


def _rated(t):
    return t.orders.withColumn("y", flag(F.col("o_orderstatus") == "F"))


def _returned(t):
    return t.lineitem.withColumn("y", flag(F.col("l_returnflag") == "R"))


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT status, count(*) AS n, round(count(*) / (SELECT count(status) FROM h), 8) AS share
    FROM h WHERE status IS NOT NULL GROUP BY 1
    """,
)
def counts_per_level(t):
    return P.value_counts(holed_orders(t), "status").withColumn("share", F.round("share", 8))


@register(
    CATALOG,
    f"""
    WITH {_LEVELS}
    SELECT CAST(e.position AS INTEGER) AS position, e.level AS o_orderpriority, count(o_orderkey) AS n
    FROM l LEFT JOIN orders ON o_orderpriority = e.level GROUP BY 1, 2
    """,
)
def counts_for_listed_levels(t):
    return P.value_counts_for(t.orders, "o_orderpriority", PRIORITIES)


@register(
    CATALOG,
    """
    SELECT o_orderpriority, count(*) FILTER (o_orderdate < '1998-01-01') AS n_a,
           count(*) FILTER (o_orderdate >= '1998-01-01' AND o_orderpriority <> '5-LOW') AS n_b
    FROM orders GROUP BY 1
    """,
)
def counts_of_two_tables(t):
    early = t.orders.where("o_orderdate < '1998-01-01'")
    late = t.orders.where("o_orderdate >= '1998-01-01' AND o_orderpriority <> '5-LOW'")
    return P.compare_value_counts(early, late, "o_orderpriority")


@register(
    CATALOG,
    _RATED + " SELECT o_orderpriority, round(avg(y) * 100, 8) AS rate_pct FROM y GROUP BY 1",
)
def rate_per_group(t):
    return P.group_rate(_rated(t), "o_orderpriority", "y").withColumn("rate_pct", F.round("rate_pct", 8))


@register(
    CATALOG,
    _RATED
    + f""", {_LEVELS}
    SELECT CAST(e.position AS INTEGER) AS position, e.level AS o_orderpriority, round(avg(y) * 100, 8) AS rate_pct
    FROM l LEFT JOIN y ON o_orderpriority = e.level GROUP BY 1, 2
    """,
)
def rate_in_fixed_order(t):
    got = P.group_rate(_rated(t), "o_orderpriority", "y", PRIORITIES)
    return got.withColumn("rate_pct", F.round("rate_pct", 8))


@register(
    CATALOG,
    """
    SELECT l_linestatus, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 8) AS rate, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def rate_and_count_per_group(t):
    return P.group_rate_count(_returned(t), "l_linestatus", "y").withColumn("rate", F.round("rate", 8))


@register(
    CATALOG,
    _RATED
    + f""", {_LEVELS}
    SELECT CAST(e.position AS INTEGER) AS position, e.level AS o_orderpriority, count(y) AS n,
           coalesce(round_even(avg(y) * 100, 1), 0) AS rate_pct
    FROM l LEFT JOIN y ON o_orderpriority = e.level GROUP BY 1, 2
    """,
)
def count_and_rate_per_listed_level(t):
    return P.rate_by_level(_rated(t), "o_orderpriority", PRIORITIES, "y")


@register(CATALOG, "SELECT count(DISTINCT text) AS n_distinct FROM documents")
def distinct_texts(t):
    return P.count_distinct(t.documents, "text")


@register(
    CATALOG,
    """
    SELECT count(*) AS raw, count(*) FILTER (o_orderpriority NOT IN ('5-LOW')) AS after_exclusion,
           count(DISTINCT o_custkey) AS raw_deduped,
           count(DISTINCT CASE WHEN o_orderpriority NOT IN ('5-LOW') THEN o_custkey END) AS final
    FROM orders
    """,
)
def rows_per_cleaning_stage(t):
    return P.stage_counts(t.orders, "o_custkey", "o_orderpriority", ["5-LOW"])


@register(
    CATALOG,
    """
    WITH c AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT (SELECT count(*) FROM orders) AS raw_rows, count(*) AS cleaned_rows,
           (SELECT count(*) FROM orders) - count(*) AS removed_rows, CAST(67 AS INTEGER) AS features,
           count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives,
           round_even(count(*) FILTER (y = 1) * 100.0::DOUBLE / count(*), 1) AS rate_pct
    FROM c
    """,
)
def cleaning_totals(t):
    return P.cleaning_stats(t.orders, _rated(t).where("o_orderpriority <> '5-LOW'"), "y", 67)


def _describe_sql(numeric: list[str], other: dict[str, str], view: str) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count(*) AS "rows", count(*) - count({c}) AS missing,
            count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min,
            round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS max FROM {view}"""
        for c, kind in numeric
    ]
    parts += [
        f"""SELECT '{c}', '{kind}', count(*), count(*) - count({c}), count({c}), NULL::DOUBLE, NULL::DOUBLE,
            NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM {view}"""
        for c, kind in other
    ]
    return " UNION ALL ".join(parts)


@register(
    CATALOG,
    ORDERS_VIEW
    + _describe_sql(
        [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("price", "double")],
        [("status", "string"), ("priority", "string")],
        "h",
    ),
)
def describe_table(t):
    got = P.describe(holed_orders(t))
    return got.withColumns(
        {**{c: F.round(c, 4) for c in ("mean", "std")}, **{c: F.round(c, 6) for c in ("p25", "p50", "p75")}}
    )


_PAIRS = ["l_quantity", "l_extendedprice", "l_discount", "holed"]


@register(
    CATALOG,
    "WITH h AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_tax + l_discount END AS holed FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS corr FROM h" for x in _PAIRS for y in _PAIRS
    ),
)
def correlation_pairs(t):
    rows = t.lineitem.withColumn("holed", F.when(F.col("l_partkey") % 3 != 0, F.col("l_tax") + F.col("l_discount")))
    return P.correlation(rows, _PAIRS).withColumn("corr", F.round("corr", 6))


@register(
    CATALOG,
    """
    WITH s AS (SELECT min(p_size)::DOUBLE lo, max(p_size)::DOUBLE hi FROM part),
         b AS (SELECT unnest(range(15)) AS bin),
         v AS (SELECT least(floor((p_size - lo) / ((hi - lo) / 15)), 14) AS bin FROM part, s)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * (hi - lo) / 15, 8) AS low,
           round(lo + (b.bin + 1) * (hi - lo) / 15, 8) AS high, count(v.bin) AS n
    FROM b CROSS JOIN s LEFT JOIN v ON v.bin = b.bin GROUP BY b.bin, lo, hi
    """,
)
def histogram_of_sizes(t):
    got = P.histogram(t.part, "p_size", 15)
    return got.withColumns({"low": F.round("low", 8), "high": F.round("high", 8)})


@register(
    CATALOG,
    """
    WITH b AS (SELECT unnest(range(14)) AS bin), g AS (SELECT DISTINCT l_linestatus FROM lineitem),
         v AS (SELECT l_linestatus, least(floor(l_quantity), 14) - 1 AS bin FROM lineitem WHERE l_quantity BETWEEN 1 AND 15)
    SELECT l_linestatus, CAST(bin AS INTEGER) AS bin, (bin + 1)::DOUBLE AS low, (bin + 2)::DOUBLE AS high,
           n, round(n / sum(n) OVER (PARTITION BY l_linestatus), 8) AS density
    FROM (SELECT g.l_linestatus, b.bin, count(v.bin) AS n FROM g CROSS JOIN b
          LEFT JOIN v ON v.bin = b.bin AND v.l_linestatus = g.l_linestatus GROUP BY 1, 2)
    """,
)
def histogram_with_edges_by_group(t):
    got = P.histogram(t.lineitem, "l_quantity", range(1, 16), by="l_linestatus", density=True)
    return got.withColumn("density", F.round("density", 8))


@register(
    CATALOG,
    """
    WITH v AS (SELECT o_orderstatus, o_totalprice * o_totalprice / 100000 AS price FROM orders),
         q AS (SELECT o_orderstatus, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
                      quantile_cont(price, 0.75) AS q3 FROM v GROUP BY 1),
         i AS (SELECT v.*, q.*, price >= q1 - 1.5 * (q3 - q1) AND price <= q3 + 1.5 * (q3 - q1) AS inside
               FROM v JOIN q USING (o_orderstatus))
    SELECT o_orderstatus, 'price' AS "column", n, round(q1, 5) AS q1, round(median, 5) AS median, round(q3, 5) AS q3,
           round(min(CASE WHEN inside THEN price END), 5) AS whisker_low,
           round(max(CASE WHEN inside THEN price END), 5) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
    FROM i GROUP BY ALL
    """,
)
def box_plot_numbers(t):
    rows = t.orders.select("o_orderstatus", (F.col("o_totalprice") * F.col("o_totalprice") / 100000).alias("price"))
    got = P.box_stats(rows, ["price"], by="o_orderstatus")
    return got.withColumns({c: F.round(c, 5) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@register(
    CATALOG,
    """
    SELECT l_returnflag, 'l_extendedprice' AS "column", count(*) AS n,
           round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
           round(quantile_cont(l_extendedprice, 0.999), 6) AS p99_9
    FROM lineitem GROUP BY 1
    """,
)
def exact_percentiles_by_group(t):
    got = percentiles(t.lineitem, ["l_extendedprice"], [0.1, 0.5, 0.999], by=["l_returnflag"])
    return got.withColumns({c: F.round(c, 6) for c in ("p10", "p50", "p99_9")})


@register(
    CATALOG,
    """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'X') AS "X"
    FROM orders GROUP BY 1
    """,
)
def crosstab_counts(t):
    return P.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "X"])


@register(CATALOG, "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def crosstab_cells(t):
    return P.crosstab_long(t.orders, "o_orderpriority", "o_orderstatus")


_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@register(
    CATALOG,
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{f}' AS feature, round(avg({f}), 7) AS mean,
            round((avg({f}) - (SELECT avg({f}) FROM lineitem)) / (SELECT stddev_samp({f}) FROM lineitem), 7) AS z
            FROM lineitem GROUP BY 1"""
        for f in _FEATURES
    ),
)
def group_means_and_scores(t):
    got = P.group_profile(t.lineitem, "l_returnflag", _FEATURES)
    return got.withColumns({"mean": F.round("mean", 7), "z": F.round("z", 7)})


@register(
    CATALOG,
    """
    SELECT l_linenumber, count(*) AS n, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100, 8) AS rate_pct,
           round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 8) AS pct_of_total
    FROM lineitem GROUP BY 1
    """,
)
def group_sizes_and_rates(t):
    got = P.group_sizes(_returned(t), "l_linenumber", "y")
    return got.withColumns({"rate_pct": F.round("rate_pct", 8), "pct_of_total": F.round("pct_of_total", 8)})


@register(
    CATALOG,
    """
    SELECT l_linenumber, count(*) AS size, count(*) FILTER (l_returnflag = 'A') AS "n_A",
           count(*) FILTER (l_returnflag = 'R') AS "n_R", round_even(avg(l_quantity), 2) AS mean_l_quantity,
           round_even(avg(l_extendedprice), 2) AS mean_l_extendedprice
    FROM lineitem GROUP BY 1
    """,
)
def group_statistics(t):
    return P.group_stats(t.lineitem, "l_linenumber", "l_returnflag", ["A", "R"], ["l_quantity", "l_extendedprice"])


@register(
    CATALOG,
    """
    WITH g AS (SELECT l_linenumber, avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100 AS r FROM lineitem GROUP BY 1)
    SELECT l_linenumber, CAST(row_number() OVER (ORDER BY r DESC, l_linenumber) AS INTEGER) AS "rank" FROM g
    """,
)
def rank_groups_by_rate(t):
    ranked = P.rank_groups(P.group_sizes(_returned(t), "l_linenumber", "y"), "l_linenumber")
    return ranked.select("l_linenumber", "rank")


@register(CATALOG, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_orders(t):
    return P.top_k(t.orders, "o_totalprice", 15, tie="o_orderkey").select("o_orderkey", "o_totalprice")


@register(
    CATALOG,
    """
    SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 1
    """,
)
def most_common_priority(t):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return P.argmax_row(counts, "n", "o_orderpriority")


@register(
    CATALOG,
    """
    WITH p AS (SELECT DISTINCT p_size::DOUBLE AS p_size, p_retailprice FROM part)
    SELECT least((SELECT count(*) FROM part), 15000) AS points, 0::BIGINT AS not_in_table
    """,
)
def scatter_sample(t):
    points = P.scatter_points(t.part, "p_size", "p_retailprice", 15000, "p_partkey")
    strange = points.join(t.part, ["p_size", "p_retailprice"], "left_anti").agg(F.count("*").alias("n")).scalar()
    return points.agg(F.count("*").alias("points"), F.max(strange).alias("not_in_table"))


@register(
    CATALOG,
    """
    SELECT CASE p_type WHEN 'ECONOMY' THEN 'cheap' ELSE p_type END AS kind, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM part), 8) AS share
    FROM part GROUP BY 1
    """,
)
def counts_after_recode(t):
    rows = map_values(t.part, "p_type", {"ECONOMY": "cheap"}, name="kind")
    return P.value_counts(rows, "kind", sort="level").withColumn("share", F.round("share", 8))
