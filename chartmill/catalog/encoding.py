"""Queries on scalar expressions, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartmill import functions as X
from chartmill.catalog.base import Query, register
from chartmill.operators import encode as E

CATALOG: dict[str, Query] = {}

# A table of codes made from the keys, as text that serves Spark and the check.
CODES = """CASE l_partkey % 12
    WHEN 0 THEN '250.' || CAST(l_partkey % 100 AS STRING) WHEN 1 THEN 'V' || CAST(l_partkey % 90 AS STRING)
    WHEN 2 THEN 'E' || CAST(l_partkey % 1000 AS STRING) WHEN 3 THEN NULL WHEN 4 THEN ' 428 ' WHEN 5 THEN ''
    WHEN 6 THEN '785.5' WHEN 7 THEN CAST(783 + l_partkey % 8 AS STRING)
    ELSE CAST(l_partkey % 1000 AS STRING) || CASE WHEN l_partkey % 3 = 0 THEN '.9' ELSE '' END END"""


@register(CATALOG, "SELECT p_partkey, upper(trim(p_name)) AS p_name, lower(p_type) AS p_type FROM part")
def change_case(t):
    padded = F.concat(F.lit("\t "), "p_name", F.lit(" \n")).alias("p_name")
    rows = t.part.select("p_partkey", padded, "p_type")
    return E.canonical_case(E.canonical_case(rows, ["p_name"], "upper", strip=True), ["p_type", "no"], "lower")


@register(
    CATALOG,
    """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '5-LOW' THEN 'low' WHEN '1-URGENT' THEN 'urgent' ELSE o_orderpriority END AS kept,
           CASE o_orderpriority WHEN '5-LOW' THEN 'low' WHEN '1-URGENT' THEN 'urgent' END AS nulled,
           CASE o_orderpriority WHEN '5-LOW' THEN 'low' WHEN '1-URGENT' THEN 'urgent' ELSE 'rest' END AS filled
    FROM orders
    """,
)
def map_values_three_ways(t):
    words = {"5-LOW": "low", "1-URGENT": "urgent"}
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    for name, default in (("kept", X.KEEP), ("nulled", None), ("filled", "rest")):
        rows = E.map_values(rows, "o_orderpriority", words, default, name)
    return rows.drop("o_orderpriority")


@register(
    CATALOG,
    """
    WITH b AS (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN 'unknown' ELSE
                 '[' || CAST(p_size // 10 * 10 AS VARCHAR) || '-' || CAST(p_size // 10 * 10 + 10 AS VARCHAR) || ')' END AS band,
                 p_size FROM part)
    SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN (p_size // 10 * 10 + 5)::DOUBLE END AS midpoint,
           CASE WHEN p_size % 9 <> 0 THEN band END AS band FROM b
    """,
)
def band_midpoints(t):
    low = F.floor(F.col("p_size") / 10) * 10
    text = F.concat(F.lit("["), low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit(")"))
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 9 == 0, "unknown").otherwise(text).alias("b"))
    rows = rows.select("p_partkey", X.band_midpoint("b").alias("midpoint"))
    return rows.withColumn("band", X.midpoint_band("midpoint"))


_CATEGORY = """CASE WHEN code IS NULL OR trim(code) = '' OR trim(code)[1] IN ('V', 'E') THEN 'Other'
      WHEN v >= 250 AND v < 251 THEN 'Diabetes' WHEN v >= 390 AND v < 460 OR v = 785 THEN 'Circulatory'
      WHEN v >= 460 AND v < 520 OR v = 786 THEN 'Respiratory' WHEN v >= 520 AND v < 580 OR v = 787 THEN 'Digestive'
      WHEN v >= 580 AND v < 630 OR v = 788 THEN 'Genitourinary' WHEN v >= 710 AND v < 740 THEN 'Musculoskeletal'
      WHEN v >= 800 AND v < 1000 THEN 'Injury' WHEN v >= 140 AND v < 240 THEN 'Neoplasms' ELSE 'Other' END"""
_CODED = f"""
    WITH c AS (SELECT l_orderkey, l_linenumber, {CODES.replace('STRING', 'VARCHAR')} AS code FROM lineitem),
         v AS (SELECT *, TRY_CAST(trim(code) AS DOUBLE) AS v FROM c),
         g AS (SELECT l_orderkey, l_linenumber, {_CATEGORY} AS category FROM v)
"""


def _coded(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.expr(CODES).alias("code"))


@register(CATALOG, _CODED + " SELECT * FROM g")
def diagnosis_categories(t):
    return _coded(t).select("l_orderkey", "l_linenumber", X.icd9_category("code").alias("category"))


@register(
    CATALOG,
    _CODED
    + """
    SELECT l_orderkey, l_linenumber, CAST(list_position(['Diabetes', 'Circulatory', 'Respiratory', 'Digestive',
      'Genitourinary', 'Musculoskeletal', 'Injury', 'Neoplasms', 'Other'], category) - 1 AS INTEGER) AS code FROM g
    """,
)
def category_positions(t):
    category = X.icd9_category("code")
    return _coded(t).select("l_orderkey", "l_linenumber", X.position_code(category, X.ICD9_CATEGORIES, 8).alias("code"))


@register(
    CATALOG,
    """
    SELECT n_nationkey,
      CAST(CASE WHEN n_nationkey = 1 THEN 0 WHEN n_nationkey IN (2, 3, 4, 5, 10) THEN 1
                WHEN n_nationkey IN (6, 8) THEN 2 ELSE 3 END AS INTEGER) AS discharge,
      CAST(CASE WHEN n_nationkey = 1 THEN 0 WHEN n_nationkey = 7 THEN 1
                WHEN n_nationkey IN (4, 5, 6) THEN 2 ELSE 3 END AS INTEGER) AS source,
      CAST(CASE WHEN n_nationkey IN (1, 2, 3) THEN n_nationkey - 1 ELSE 3 END AS INTEGER) AS admission
    FROM nation
    """,
)
def code_groups(t):
    from chartmill.plans import encounters as W

    return t.nation.select(
        "n_nationkey",
        X.group_codes("n_nationkey", W.DISCHARGE_GROUPS, 3).alias("discharge"),
        X.group_codes("n_nationkey", W.ADMISSION_SOURCE_GROUPS, 3).alias("source"),
        X.group_codes("n_nationkey", W.ADMISSION_TYPE_GROUPS, 3).alias("admission"),
    )


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'F' THEN 3 ELSE 0 END AS INTEGER) AS l_returnflag_enc,
           CAST(CASE l_linestatus WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'F' THEN 3 ELSE 0 END AS INTEGER) AS l_linestatus_enc
    FROM lineitem
    """,
)
def encode_many_columns(t):
    coded = E.ordinal_encode(t.lineitem, ["l_returnflag", "l_linestatus"], {"A": 1, "R": 2, "F": 3})
    return coded.select("l_orderkey", "l_linenumber", "l_returnflag_enc", "l_linestatus_enc")


@register(
    CATALOG,
    """
    WITH h AS (SELECT *, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS q,
                         CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_returnflag END AS f FROM lineitem)
    SELECT l_orderkey, l_linenumber,
      CAST(coalesce(f = 'R', false) AS INTEGER) AS is_r,
      CAST(coalesce(q >= 40, false) AS INTEGER) AS big,
      CAST(coalesce(l_linenumber IN (1, 3, 7), false) AS INTEGER) AS chosen,
      CAST(coalesce(q < 20 AND f = 'A' AND l_discount > 0.05, false) AS INTEGER) AS every,
      CAST(coalesce(q > 45, false) OR coalesce(f = 'N', false) OR l_tax = 0 AS INTEGER) AS some,
      CAST(coalesce(q > 25, false)::INT + (l_discount > 0.02)::INT + (l_tax > 0.03)::INT AS INTEGER) AS hits
    FROM h
    """,
)
def row_flags(t):
    q = F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity"))
    f = F.when(F.col("l_suppkey") % 4 != 0, F.col("l_returnflag"))
    rows = t.lineitem.withColumns({"q": q, "f": f})
    scaled = [F.col("q") / 25.0, F.col("l_discount") / 0.02, F.col("l_tax") / 0.03]
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        X.equals("f", "R").alias("is_r"),
        X.threshold("q", ">=", 40).alias("big"),
        X.in_set("l_linenumber", [1, 3, 7]).alias("chosen"),
        X.all_of(F.col("q") < 20, F.col("f") == "A", F.col("l_discount") > 0.05).alias("every"),
        X.any_of(F.col("q") > 45, F.col("f") == "N", F.col("l_tax") == 0).alias("some"),
        X.count_where(scaled, lambda c: c > 1.0).alias("hits"),
    )


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber
             + CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_suppkey END AS total,
           round(l_quantity / (l_linenumber + 1), 8) AS per_line,
           round(l_quantity / CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber - 1 END, 8) AS per_other
    FROM lineitem
    """,
)
def row_sums_and_ratios(t):
    rows = t.lineitem.withColumn("s", F.when(F.col("l_partkey") % 5 != 0, F.col("l_suppkey")))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        X.row_sum(["l_quantity", "l_linenumber", "s"]).alias("total"),
        F.round(X.ratio("l_quantity", "l_linenumber"), 8).alias("per_line"),
        F.round(X.ratio("l_quantity", "l_linenumber", -1), 8).alias("per_other"),
    )


@register(
    CATALOG,
    """
    SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS "p_1-urgent",
           CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "p_5-low", CAST(0 AS INTEGER) AS p_none
    FROM orders
    """,
)
def one_hot_levels(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return E.one_hot(rows, "o_orderpriority", ["1-URGENT", "5-LOW", "None"], "p_").drop("o_orderpriority")


@register(
    CATALOG, "SELECT o_orderkey, round(ln(1 + o_totalprice), 8) AS o_totalprice FROM orders"
)
def log_scale(t):
    rows = E.log1p(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "no"])
    return rows.withColumn("o_totalprice", F.round("o_totalprice", 8))


@register(
    CATALOG,
    """
    WITH s AS (SELECT avg(l_quantity) m, stddev_pop(l_quantity) p, stddev_samp(l_quantity) d FROM lineitem)
    SELECT l_orderkey, l_linenumber, round((l_quantity - m) / p, 7) AS population, round((l_quantity - m) / d, 7) AS sample,
           CAST(0 AS DOUBLE) AS flat
    FROM lineitem, s
    """,
)
def standard_scores(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("population"), F.col("l_quantity").alias("sample"),
        F.lit(3.0).alias("flat"),
    )
    rows = E.standardise(E.standardise(rows, ["population", "flat"]), ["sample"], ddof=1)
    return rows.withColumns({c: F.round(c, 7) for c in ("population", "sample")})


@register(
    CATALOG,
    """
    WITH s AS (SELECT *, CAST(l_partkey % 97 AS DOUBLE) / 97.0 AS p FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           CASE WHEN p >= 0.5 THEN 'Early Readmission Risk' ELSE 'Low Readmission Risk' END AS text,
           round_even(p * 100, 1) AS pct FROM s
    """,
)
def prediction_texts(t):
    rows = t.lineitem.withColumn("p", (F.col("l_partkey") % 97) / F.lit(97.0))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        X.label_case(X.threshold("p", ">=", 0.5)).alias("text"),
        X.percent("p").alias("pct"),
    )


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_linenumber,
      CASE WHEN l_quantity >= 40 THEN 'Good' WHEN l_quantity >= 30 THEN 'Moderate' WHEN l_quantity >= 20 THEN 'Poor'
           ELSE 'Very Poor' END AS grade,
      CASE WHEN l_tax > 0.06 THEN 'red' WHEN l_tax > 0.02 THEN 'orange' ELSE 'yellow' END AS colour
    FROM lineitem
    """,
)
def report_bands(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        X.band("l_quantity", [40, 30, 20], ["Good", "Moderate", "Poor", "Very Poor"]).alias("grade"),
        X.band("l_tax", [0.06, 0.02], ["red", "orange", "yellow"], inclusive=False).alias("colour"),
    )


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS "l_quantity*l_discount",
           l_quantity * l_tax AS "l_quantity*l_tax", l_discount * l_tax AS "l_discount*l_tax"
    FROM lineitem
    """,
)
def column_products(t):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return E.pairwise_interactions(t.lineitem, cols).select(
        "l_orderkey", "l_linenumber", *[X.col_of(n) for n in E.interaction_names(cols)]
    )
