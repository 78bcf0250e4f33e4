"""Queries on sources, row filters, duplicates and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.catalog.base import Query, Tables, register, scratch
from chartmill.functions import flag
from chartmill.operators import duplicates as D
from chartmill.operators import missing as M
from chartmill.operators import rows as R
from chartmill.operators.models import BoostConfig, score, train_gbt
from chartmill.operators.profiling import group_rate_count
from chartmill.sources import tables as S

CATALOG: dict[str, Query] = {}

# Missing values and text tokens, put into complete tables; the same text serves Spark and the check.
HOLED_ORDERS = [
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status",
    "CASE WHEN o_orderkey % 11 < 6 THEN NULL ELSE o_orderpriority END AS priority",
]
HOLED_CUSTOMER = [
    "c_custkey",
    "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS balance",
    "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey END AS nation",
    "CASE WHEN c_custkey % 10 = 0 THEN 'nan' WHEN c_custkey % 10 = 1 THEN '' ELSE c_mktsegment END AS segment",
    "CASE WHEN c_custkey % 9 = 0 THEN 'UNKNOWN' WHEN c_custkey % 9 = 1 THEN NULL ELSE c_mktsegment END AS label",
]


def sql_view(name: str, columns: list[str], table: str) -> str:
    return f"{name} AS (SELECT {', '.join(columns)} FROM {table})"


ORDERS_VIEW = "WITH " + sql_view("h", HOLED_ORDERS, "orders")
CUSTOMER_VIEW = "WITH " + sql_view("h", HOLED_CUSTOMER, "customer")


def holed_orders(t: Tables):
    return t.orders.selectExpr(*HOLED_ORDERS)


def holed_customer(t: Tables):
    return t.customer.selectExpr(*HOLED_CUSTOMER)


# ---------------------------------------------------------------- sources

_CSV_CELLS = [
    "o_orderkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN '?' WHEN o_orderkey % 7 = 1 THEN 'NaN' ELSE CAST(o_totalprice AS STRING) END AS price",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' WHEN o_orderkey % 5 = 1 THEN '' WHEN o_orderkey % 5 = 2 THEN '?'"
    " ELSE o_orderpriority END AS priority",
]
_CSV_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("priority", T.StringType()),
    ]
)


def _csv(t: Tables) -> str:
    path = scratch(t.spark) + "/orders_csv"
    S.write_table(t.orders.selectExpr(*_CSV_CELLS), path, fmt="csv")
    return path


@register(
    CATALOG,
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 7 < 2 THEN NULL ELSE o_totalprice END AS price,
           CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def csv_default_tokens(t):
    return S.read_table_csv(t.spark, _csv(t), _CSV_SCHEMA, ["?"])


@register(
    CATALOG,
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 7 < 2 THEN NULL ELSE o_totalprice END AS price,
           CASE o_orderkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN '?' ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def csv_only_empty_is_missing(t):
    return S.read_table_csv(t.spark, _csv(t), _CSV_SCHEMA, [""], keep_default_na=False)


@register(
    CATALOG,
    """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'None' ELSE o_orderstatus END AS result
    FROM orders
    """,
)
def table_round_trip(t):
    path = scratch(t.spark) + "/orders"
    result = F.when(F.col("o_orderkey") % 3 == 0, "None").otherwise(F.col("o_orderstatus")).alias("result")
    S.write_table(t.orders.select("o_orderkey", "o_totalprice", result), path)
    return t.spark.read.parquet(path)


@register(CATALOG, "SELECT c_custkey, c_acctbal, 1 AS build FROM customer")
def cached_table_reuse(t):
    path = scratch(t.spark) + "/customer"

    def build(i):
        return lambda: t.customer.select("c_custkey", "c_acctbal", F.lit(i).alias("build"))

    S.cached_table(t.spark, path, build(1))
    return S.cached_table(t.spark, path, build(2))


@register(
    CATALOG, "SELECT CAST(2 AS INTEGER) AS version, count(*) AS n FROM customer WHERE c_acctbal > 0"
)
def versioned_table_latest(t):
    base = scratch(t.spark) + "/customer"
    S.write_versioned(t.customer, base)
    S.write_versioned(t.customer.where("c_acctbal > 0"), base)
    last = S.versions(t.spark, base)[-1]
    return S.latest_version(t.spark, base).agg(F.lit(last).alias("version"), F.count("*").alias("n"))


@register(
    CATALOG,
    """
    SELECT l_returnflag, round(avg(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END), 8) AS rate, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def metrics_round_trip(t):
    path = scratch(t.spark) + "/metrics"
    rated = t.lineitem.withColumn("y", flag(F.col("l_linestatus") == "F"))
    S.write_metrics(group_rate_count(rated, "l_returnflag", "y"), path)
    back = S.read_metrics(t.spark, path, "l_returnflag string, rate double, n bigint")
    return back.withColumn("rate", F.round("rate", 8))


@register(CATALOG, "SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed FROM orders")
def model_round_trip(t):
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", (F.col("o_custkey") % 10).cast("double").alias("x"),
        flag(F.col("o_orderstatus") == "F").alias("y"),
    )
    features = ["o_totalprice", "x"]
    path = scratch(t.spark) + "/model"
    model = S.load_or_train(path, lambda: train_gbt(rows, features, "y", BoostConfig(trees=3, depth=2)), t.spark)
    again = S.load_model(path)
    assert S.model_features(again) == features
    both = score(again, score(model, rows, "a", "ca"), "b", "cb")
    return both.agg(F.count("*").alias("n"), F.count(F.when(F.col("a") != F.col("b"), 1)).alias("changed"))


# ---------------------------------------------------------------- projections and filters


@register(
    CATALOG,
    """
    SELECT l_quantity, l_discount, l_tax, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned
    FROM lineitem
    """,
)
def select_model_columns(t):
    rows = t.lineitem.withColumn("returned", flag(F.col("l_returnflag") == "R"))
    return R.select_features(rows, ["l_quantity", "l_discount", "l_tax"], "returned")


@register(CATALOG, "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def drop_present_columns(t):
    return R.drop_columns(t.orders, ["o_orderdate", "o_orderpriority", "not_there"])


@register(CATALOG, "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def normalise_header(t):
    messy = t.customer.select(F.col("c_custkey").alias(" C_CustKey "), F.col("c_mktsegment").alias("SEGMENT"))
    return R.normalise_names(messy)


@register(CATALOG, "SELECT p_partkey, p_type AS cp, p_size FROM part")
def take_over_column(t):
    rows = t.part.select("p_partkey", F.col("p_type").alias("chestpaintype"), "p_size")
    return R.coalesce_column(R.coalesce_column(rows, "cp", "chestpaintype"), "cp", "chestpaintype")


@register(
    CATALOG,
    ORDERS_VIEW + " SELECT o_orderkey, priority FROM h WHERE priority IS NULL OR priority NOT IN ('5-LOW', '1-URGENT')",
)
def exclude_coded_rows(t):
    return R.exclude_values(holed_orders(t), "priority", ["5-LOW", "1-URGENT"]).select("o_orderkey", "priority")


@register(CATALOG, CUSTOMER_VIEW + " SELECT c_custkey, label FROM h WHERE label IS DISTINCT FROM 'UNKNOWN'")
def keep_labelled_rows(t):
    return R.keep_labelled(holed_customer(t), "label").select("c_custkey", "label")


@register(
    CATALOG,
    """
    WITH h AS (SELECT p_partkey, CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_size END AS size, p_retailprice FROM part)
    SELECT * FROM h WHERE (size IS NULL OR size < 40) AND p_retailprice BETWEEN 950 AND 1500
    """,
)
def filter_outliers(t):
    rows = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") % 8 != 0, F.col("p_size")).alias("size"), "p_retailprice"
    )
    return R.filter_ranges(rows, {"size": (None, 40, "neither"), "p_retailprice": (950, 1500, "both"), "no": (1, 2, "both")})


@register(
    CATALOG,
    ORDERS_VIEW + " SELECT o_orderkey, price, status FROM h WHERE price IS NOT NULL AND status IS NOT NULL",
)
def drop_rows_with_nulls(t):
    kept = R.drop_null_rows(R.drop_null_rows(holed_orders(t), ["status"]), ["price", "not_there"])
    return kept.select("o_orderkey", "price", "status")


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem
    """,
)
def numeric_columns_only(t):
    return t.lineitem.select(*R.numeric_columns(t.lineitem))


@register(
    CATALOG,
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000
    """,
)
def append_rows(t):
    a = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    b = t.orders.where("o_totalprice > 200000").select("o_totalprice", "o_orderkey")
    return R.append(a, b)


# ---------------------------------------------------------------- duplicates


@register(
    CATALOG,
    """
    SELECT doc_id, text, lang, group_size
    FROM (SELECT doc_id, text, lang, count(*) OVER (PARTITION BY text) AS group_size FROM documents)
    WHERE group_size > 1
    """,
)
def duplicate_groups(t):
    return D.duplicate_report(t.documents.select("doc_id", "text", "lang"), ["text"])


@register(
    CATALOG,
    """
    WITH r AS (SELECT l_quantity, l_discount, l_returnflag, count(*) AS group_size
               FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    SELECT l_quantity, l_discount, l_returnflag, group_size, count(*) AS members
    FROM r CROSS JOIN LATERAL (SELECT unnest(range(r.group_size))) GROUP BY ALL
    """,
)
def duplicate_rows_in_full(t):
    rows = t.lineitem.select("l_quantity", "l_discount", "l_returnflag")
    report = D.duplicate_report(rows)
    return report.groupBy(*report.columns).agg(F.count("*").alias("members"))


@register(
    CATALOG,
    """
    SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents)
    WHERE r = 1
    """,
)
def drop_duplicates_keep_first(t):
    return D.drop_duplicate_rows(t.documents.select("doc_id", "text"), ["text"], "first", "doc_id")


@register(
    CATALOG,
    """
    SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS r FROM documents)
    WHERE r = 1
    """,
)
def drop_duplicates_keep_last(t):
    return D.drop_duplicate_rows(t.documents.select("doc_id", "text"), ["text"], "last", "doc_id")


@register(
    CATALOG,
    """
    SELECT doc_id, text FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n = 1
    """,
)
def drop_duplicates_keep_none(t):
    return D.drop_duplicate_rows(t.documents.select("doc_id", "text"), ["text"], keep=False)


@register(CATALOG, "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def drop_duplicate_whole_rows(t):
    return D.drop_duplicate_rows(t.lineitem.select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


@register(
    CATALOG,
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1
    """,
)
def first_order_per_customer(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return D.first_per_key(rows, "o_custkey", "o_orderkey")


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS groups, CAST(sum(n) - count(*) AS BIGINT) AS surplus
    FROM (SELECT status, o_custkey, count(*) AS n FROM h GROUP BY 1, 2)
    """,
)
def count_repeated_keys(t):
    return D.count_surplus(holed_orders(t), ["status", "o_custkey"])


# ---------------------------------------------------------------- missing values

_PROFILE = ORDERS_VIEW + """, p AS (
    SELECT count(*) AS n, [{'c': 'o_orderkey', 'm': count(*) - count(o_orderkey)},
                           {'c': 'o_custkey', 'm': count(*) - count(o_custkey)},
                           {'c': 'price', 'm': count(*) - count(price)},
                           {'c': 'status', 'm': count(*) - count(status)},
                           {'c': 'priority', 'm': count(*) - count(priority)}] AS l FROM h),
    q AS (SELECT n, unnest(l) AS e FROM p),
    m AS (SELECT e.c AS "column", e.m AS missing_count, e.m * 100.0::DOUBLE / n AS missing_pct FROM q)
"""


@register(CATALOG, _PROFILE + ' SELECT "column", missing_count, round(missing_pct, 8) AS missing_pct FROM m')
def missing_per_column(t):
    return M.missing_profile(holed_orders(t)).withColumn("missing_pct", F.round("missing_pct", 8))


@register(
    CATALOG,
    _PROFILE
    + """
    SELECT CAST(sum(missing_count) AS BIGINT) AS missing_total, round(avg(missing_pct), 8) AS missing_pct,
           round(100 - avg(missing_pct), 8) AS completeness_pct FROM m
    """,
)
def missing_in_table(t):
    got = M.missing_total(holed_orders(t))
    return got.withColumns({c: F.round(c, 8) for c in ("missing_pct", "completeness_pct")})


@register(
    CATALOG,
    _PROFILE
    + """
    SELECT "column", missing_count, round(missing_pct, 8) AS missing_pct,
           CASE WHEN missing_pct > 30 THEN 'red' WHEN missing_pct > 5 THEN 'orange' ELSE 'yellow' END AS severity
    FROM m WHERE missing_count > 0 ORDER BY missing_pct DESC, "column" LIMIT 15
    """,
)
def worst_missing_columns(t):
    return M.top_missing(holed_orders(t)).withColumn("missing_pct", F.round("missing_pct", 8))


@register(
    CATALOG,
    CUSTOMER_VIEW
    + """
    SELECT c_custkey, balance, nation, CASE WHEN segment IN ('nan', '') THEN NULL ELSE segment END AS segment, label
    FROM h
    """,
)
def null_text_tokens(t):
    return M.nullify_tokens(holed_customer(t))


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT o_orderkey, price, coalesce(status, 'Unknown') AS status, coalesce(priority, 'None') AS priority FROM h
    """,
)
def fill_with_constants(t):
    filled = M.fill_constant(holed_orders(t), {"status": "Unknown", "priority": "None", "not_there": "x"})
    return filled.drop("o_custkey")


@register(
    CATALOG,
    CUSTOMER_VIEW
    + """
    SELECT c_custkey, round(coalesce(balance, (SELECT avg(balance) FROM h)), 6) AS balance,
           round(coalesce(nation::DOUBLE, (SELECT avg(nation) FROM h)), 6) AS nation FROM h
    """,
)
def fill_with_means(t):
    got = M.fill_mean(holed_customer(t), ["balance", "nation"])
    return got.select("c_custkey", F.round("balance", 6).alias("balance"), F.round("nation", 6).alias("nation"))


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT o_orderkey, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM h)), 6) AS price FROM h
    """,
)
def fill_with_medians(t):
    got = M.fill_median(holed_orders(t), ["price"])
    return got.select("o_orderkey", F.round("price", 6).alias("price"))


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT o_orderkey,
      coalesce(status, (SELECT status FROM h WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS status,
      coalesce(priority,
        (SELECT priority FROM h WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority
    FROM h
    """,
)
def fill_with_modes(t):
    return M.fill_mode(holed_orders(t), ["status", "priority"]).select("o_orderkey", "status", "priority")


@register(CATALOG, ORDERS_VIEW + " SELECT o_orderkey, coalesce(price, 0.0) AS price FROM h")
def fill_with_zero(t):
    return M.fill_zero(holed_orders(t), ["price"]).select("o_orderkey", "price")


@register(
    CATALOG,
    """
    WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '?' WHEN o_orderkey % 6 = 1 THEN 'n/a'
                                       WHEN o_orderkey % 6 = 2 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS code
               FROM orders)
    SELECT o_orderkey, TRY_CAST(code AS DOUBLE) AS code, coalesce(TRY_CAST(code AS INTEGER), 1) AS code_int FROM h
    """,
)
def coerce_to_numbers(t):
    key = F.col("o_orderkey") % 6
    text = F.when(key == 0, "?").when(key == 1, "n/a").when(key > 2, F.col("o_custkey").cast("string"))
    rows = t.orders.select("o_orderkey", text.alias("code"), text.alias("code_int"))
    return M.to_numeric(M.to_numeric(rows, ["code"]), ["code_int"], "int", 1)


@register(
    CATALOG,
    CUSTOMER_VIEW
    + """, b AS (SELECT count(*) AS n, [{'c': 'c_custkey', 'm': count(*) - count(c_custkey)},
                                      {'c': 'balance', 'm': count(*) - count(balance)},
                                      {'c': 'nation', 'm': count(*) - count(nation)},
                                      {'c': 'segment', 'm': count(*) - count(segment)},
                                      {'c': 'label', 'm': count(*) - count(label)}] AS l,
                        (SELECT count(*) FROM h WHERE balance IS NOT NULL) AS na FROM h),
       a AS (SELECT unnest([{'c': 'c_custkey', 'm': 0::BIGINT}, {'c': 'balance', 'm': 0::BIGINT},
                            {'c': 'label', 'm': (SELECT count(*) - count(label) FROM h WHERE balance IS NOT NULL)}]) AS e),
       u AS (SELECT n, na, unnest(l) AS e FROM b)
    SELECT u.e.c AS "column", u.n AS rows_before, u.e.m AS missing_before, CAST(5 AS INTEGER) AS columns_before,
           CASE WHEN a.e.c IS NOT NULL THEN u.na END AS rows_after, a.e.m AS missing_after,
           CASE WHEN a.e.c IS NOT NULL THEN CAST(3 AS INTEGER) END AS columns_after
    FROM u LEFT JOIN a ON u.e.c = a.e.c
    """,
)
def missing_before_and_after(t):
    before = holed_customer(t)
    after = R.drop_null_rows(before, ["balance"]).select("c_custkey", "balance", "label")
    return M.cleaning_summary(before, after)


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT count(*) AS total_rows, CAST(5 AS INTEGER) AS total_cols,
           round_even((5.0::DOUBLE * count(*) - count(o_orderkey) - count(o_custkey) - count(price) - count(status)
                      - count(priority)) * 100 / (5 * count(*)), 1) AS total_missing_pct,
           count(*) FILTER (priority IN ('5-LOW')) AS excluded_rows,
           CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM h)) AS BIGINT) AS surplus_rows,
           count(*) FILTER (status = 'P') AS invalid_rows
    FROM h
    """,
)
def defects_of_raw_table(t):
    return M.dirty_stats(holed_orders(t), "o_custkey", ("priority", ["5-LOW"]), ("status", "P")).drop("missing_by_col")


@register(
    CATALOG,
    ORDERS_VIEW
    + """
    SELECT 'price' AS "column", round_even((count(*) - count(price)) * 100.0::DOUBLE / count(*), 1) AS pct FROM h
    UNION ALL SELECT 'status', round_even((count(*) - count(status)) * 100.0::DOUBLE / count(*), 1) FROM h
    UNION ALL SELECT 'priority', round_even((count(*) - count(priority)) * 100.0::DOUBLE / count(*), 1) FROM h
    """,
)
def defect_shares_by_column(t):
    stats = M.dirty_stats(holed_orders(t), "o_custkey", ("priority", ["5-LOW"]), ("status", "P"))
    return stats.select(F.explode("missing_by_col").alias("column", "pct"))


@register(
    CATALOG,
    CUSTOMER_VIEW
    + """
    SELECT c_custkey, round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM h)), 6) AS balance,
           round(coalesce(nation::DOUBLE, (SELECT avg(nation) FROM h)), 6) AS nation,
           coalesce(CASE WHEN segment IN ('nan', '') THEN NULL ELSE segment END,
             (SELECT segment FROM h WHERE segment NOT IN ('nan', '') GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS segment,
           coalesce(label, 'UNKNOWN') AS label
    FROM h
    """,
)
def impute_by_strategy(t):
    plan = {"balance": "median", "nation": "mean", "segment": "mode", "label": ("constant", "UNKNOWN")}
    got = M.impute(M.nullify_tokens(holed_customer(t)), plan)
    return got.withColumns({c: F.round(c, 6) for c in ("balance", "nation")})
