"""Queries on splits, weights, classifier metrics, training and scoring."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from chartmill.catalog.base import Query, Tables, register
from chartmill.functions import flag
from chartmill.operators import downdating as D
from chartmill.operators import fit_checks as C
from chartmill.operators import metrics as L
from chartmill.operators import models as Z
from chartmill.operators import neighbours as N
from chartmill.operators import sampling as T
from chartmill.operators.stages import written

CATALOG: dict[str, Query] = {}


# ---------------------------------------------------------------- sampling and splits


@register(
    CATALOG,
    """
    SELECT o_orderpriority, count(*) AS n, CAST(1 AS INTEGER) AS shares_hold
    FROM orders GROUP BY 1
    """,
)
def split_by_hash(t):
    parts = T.stratified_split(t.orders, "o_orderpriority", [0.6, 0.2, 0.2], "o_orderkey")
    share = F.avg(flag(F.col("split") == 0))
    # Five standard errors of a 60 % share.
    near = F.abs(share - 0.6) < F.lit(5.0) * F.sqrt(F.lit(0.24) / F.count("*"))
    return parts.groupBy("o_orderpriority").agg(F.count("*").alias("n"), flag(near).alias("shares_hold"))


@register(
    CATALOG,
    """
    WITH g AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, CAST(0 AS INTEGER) AS split, CAST(floor(n * 0.8::DOUBLE + 0.5) AS BIGINT) AS n FROM g
    UNION ALL SELECT o_orderpriority, 1, CAST(n - floor(n * 0.8::DOUBLE + 0.5) AS BIGINT) FROM g
    """,
)
def split_exactly(t):
    parts = T.stratified_split(t.orders, "o_orderpriority", [0.8, 0.2], "o_orderkey", exact=True)
    return parts.groupBy("o_orderpriority", "split").agg(F.count("*").alias("n"))


@register(
    CATALOG,
    """
    WITH g AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1), f AS (SELECT unnest(range(5)) AS fold)
    SELECT o_orderpriority, CAST(fold AS INTEGER) AS fold, CAST(n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n
    FROM g, f
    """,
)
def assign_folds_exactly(t):
    folds = T.kfold_assign(t.orders, "o_orderpriority", 5, "o_orderkey", exact=True)
    return folds.groupBy("o_orderpriority", "fold").agg(F.count("*").alias("n"))


@register(
    CATALOG,
    "SELECT count(*) AS n, CAST(5 AS BIGINT) AS folds, CAST(1 AS INTEGER) AS folds_even FROM orders",
)
def assign_folds_by_hash(t):
    folds = T.kfold_assign(t.orders, "o_orderpriority", 5, "o_orderkey").groupBy("fold").agg(F.count("*").alias("n"))
    total = F.sum("n")
    even = F.max("n") - F.min("n") < F.lit(10.0) * F.sqrt(total * 0.16)
    return folds.agg(total.alias("n"), F.count("*").alias("folds"), flag(even).alias("folds_even"))


@register(
    CATALOG,
    """
    SELECT least(count(*), 8000) AS n, least(count(*), 8000) AS different, CAST(0 AS BIGINT) AS strange FROM orders
    """,
)
def sample_without_replacement(t):
    picked = T.sample_rows(t.orders, 8000, "o_orderkey")
    strange = picked.join(t.orders, picked.columns, "left_anti").agg(F.count("*").alias("n")).scalar()
    return picked.agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("different"), F.max(strange).alias("strange")
    )


_DRAWN = """
    WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY ('0x' || md5('42:' || o_orderkey)[:15])::BIGINT) - 1 AS place FROM orders),
         n AS (SELECT unnest(range(2 * count(*))) AS i FROM orders),
         d AS (SELECT ('0x' || md5('42:draw:' || i)[:15])::BIGINT % (SELECT count(*) FROM orders) AS place FROM n)
    SELECT o_orderkey, count(*) AS copies FROM d JOIN o USING (place) GROUP BY o_orderkey
"""


@register(CATALOG, _DRAWN)
def sample_with_replacement(t):
    drawn = T.bootstrap(t.orders, 2 * t.orders.count(), "o_orderkey")
    return drawn.groupBy("o_orderkey").agg(F.count("*").alias("copies"))


_WEIGHTS = """
    WITH g AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber,
           round((SELECT count(*) FROM lineitem) / ((SELECT count(*) FROM g) * g.n::DOUBLE), 8) AS weight
    FROM lineitem JOIN g USING (l_returnflag)
"""


@register(CATALOG, _WEIGHTS)
def class_weights(t):
    got = T.balanced_weights(t.lineitem, "l_returnflag")
    return got.select("l_orderkey", "l_linenumber", F.round("weight", 8).alias("weight"))


@register(CATALOG, _WEIGHTS)
def class_weights_of_many_labels(t):
    got = T.balanced_weights(t.lineitem, "l_returnflag", few=1)
    return got.select("l_orderkey", "l_linenumber", F.round("weight", 8).alias("weight"))


# ---------------------------------------------------------------- metrics of given scores

SCORED = """s AS (SELECT CAST(l_partkey % 97 AS DOUBLE) / 97.0 AS score, CAST(l_partkey % 97 AS DOUBLE) / 97.0 >= 0.5 AS p,
                        l_returnflag = 'R' AS y FROM lineitem)"""
# Every row a score of its own, some tied.
FINE = """s AS (SELECT l_extendedprice / 110000.0 AS score, l_returnflag = 'R' AS y FROM lineitem)"""
RANKED = """, c AS (SELECT score, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM s GROUP BY 1),
    r AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
          FROM c WINDOW w AS (ORDER BY score DESC))"""


def _scored(t: Tables):
    return t.lineitem.select(
        ((F.col("l_partkey") % 97) / F.lit(97.0)).alias("score"), flag(F.col("l_returnflag") == "R").alias("y")
    ).withColumn("pred", flag(F.col("score") >= 0.5))


def _fine(t: Tables):
    return t.lineitem.select((F.col("l_extendedprice") / 110000.0).alias("score"), flag(F.col("l_returnflag") == "R").alias("y"))


def _rounded(df, digits=7):
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema])


def _report_sql(weight: str) -> str:
    zero = "0" if weight == "1" else "0.0"
    return f"""
    WITH s AS (SELECT CAST(l_partkey % 97 AS DOUBLE) / 97.0 AS score, CAST(l_partkey % 97 AS DOUBLE) / 97.0 >= 0.5 AS p,
                      l_returnflag = 'R' AS y, {weight} AS w FROM lineitem),
    q AS (SELECT score, sum(CASE WHEN y THEN w ELSE {zero} END) AS pos, sum(CASE WHEN y THEN {zero} ELSE w END) AS neg FROM s GROUP BY 1),
    r AS (SELECT *, sum(pos) OVER v AS cp, sum(neg) OVER v AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
          FROM q WINDOW v AS (ORDER BY score DESC)),
    a AS (SELECT sum(neg * (cp - pos / 2.0)) / (max(tp)::DOUBLE * max(tn)) AS auc,
                 sum(pos * cp::DOUBLE / (cp + cn)) / max(tp) AS ap FROM r),
    m AS (SELECT sum(w) AS n, sum(CASE WHEN NOT y AND NOT p THEN w ELSE {zero} END) AS tn,
                 sum(CASE WHEN NOT y AND p THEN w ELSE {zero} END) AS fp, sum(CASE WHEN y AND NOT p THEN w ELSE {zero} END) AS fn,
                 sum(CASE WHEN y AND p THEN w ELSE {zero} END) AS tp, sum(score * w) / sum(w) AS mean_score,
                 sum(greatest(score, 1 - score) * w) / sum(w) AS mean_confidence FROM s),
    k AS (SELECT *, tn / (tn + fn)::DOUBLE AS p0, tn / (tn + fp)::DOUBLE AS r0, tp / (tp + fp)::DOUBLE AS p1,
                 tp / (tp + fn)::DOUBLE AS r1, tn + fp AS s0, tp + fn AS s1 FROM m),
    f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM k)
    """


_METRIC_COLUMNS = """round((tn + tp) / n::DOUBLE, 7) AS accuracy, round(auc, 7) AS roc_auc, round(ap, 7) AS average_precision,
           round(p0, 7) AS precision_0, round(r0, 7) AS recall_0, round(f0, 7) AS f1_0, {support_0} AS support_0,
           round(p1, 7) AS precision_1, round(r1, 7) AS recall_1, round(f1, 7) AS f1_1, {support_1} AS support_1,
           round((p0 + p1) / 2, 7) AS precision_macro, round((r0 + r1) / 2, 7) AS recall_macro, round((f0 + f1) / 2, 7) AS f1_macro,
           round((p0 * s0 + p1 * s1) / n, 7) AS precision_weighted, round((r0 * s0 + r1 * s1) / n, 7) AS recall_weighted,
           round((f0 * s0 + f1 * s1) / n, 7) AS f1_weighted, round(mean_score, 7) AS mean_score,
           round(mean_confidence, 7) AS mean_confidence FROM f, a"""


@register(
    CATALOG,
    _report_sql("1")
    + "SELECT CAST(n AS BIGINT) AS n, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,"
    " CAST(tp AS BIGINT) AS tp, "
    + _METRIC_COLUMNS.format(support_0="CAST(s0 AS BIGINT)", support_1="CAST(s1 AS BIGINT)"),
)
def classifier_metrics(t):
    return _rounded(L.binary_metrics(_scored(t), "y", "score", "pred"))


@register(
    CATALOG,
    _report_sql("l_quantity")
    + "SELECT round(n, 7) AS n, round(tn, 7) AS tn, round(fp, 7) AS fp, round(fn, 7) AS fn, round(tp, 7) AS tp, "
    + _METRIC_COLUMNS.format(support_0="round(s0, 7)", support_1="round(s1, 7)"),
)
def weighted_classifier_metrics(t):
    rows = t.lineitem.select(
        ((F.col("l_partkey") % 97) / F.lit(97.0)).alias("score"), flag(F.col("l_returnflag") == "R").alias("y"), "l_quantity"
    )
    return _rounded(L.binary_metrics(rows, "y", "score", weight="l_quantity"))


@register(
    CATALOG,
    f"""WITH {FINE}{RANKED}
    SELECT round(sum(neg * (cp - pos / 2.0)) / (max(p)::DOUBLE * max(n)), 8) AS roc_auc,
           round(sum(pos * cp::DOUBLE / (cp + cn)) / max(p), 8) AS average_precision FROM r""",
)
def areas_over_fine_scores(t):
    return _rounded(L.curve_areas(_fine(t), "y", "score"), 8)


@register(
    CATALOG,
    f"""WITH {FINE}{RANKED}
    SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
    UNION ALL SELECT round(score, 8), round(cn / n::DOUBLE, 8), round(cp / p::DOUBLE, 8) FROM r""",
)
def roc_points(t):
    return _rounded(L.roc_curve(_fine(t), "y", "score"), 8)


@register(
    CATALOG,
    f"""WITH {SCORED}{RANKED}
    , d AS (SELECT *, lag(cn) OVER w AS pn, lead(cn) OVER w AS nn, lag(cp) OVER w AS pp, lead(cp) OVER w AS np
            FROM r WINDOW w AS (ORDER BY score DESC))
    SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
    UNION ALL SELECT round(score, 8), round(cn / n::DOUBLE, 8), round(cp / p::DOUBLE, 8) FROM d
    WHERE NOT (coalesce(cn = pn AND cn = nn, false) OR coalesce(cp = pp AND cp = np, false))""",
)
def roc_corner_points(t):
    return _rounded(L.roc_curve(_scored(t), "y", "score", drop_intermediate=True), 8)


@register(
    CATALOG,
    f"""WITH {SCORED}
    SELECT CAST(y AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, count(*) AS n FROM s GROUP BY 1, 2""",
)
def confusion_cells(t):
    return L.confusion_matrix(_scored(t), "y", "pred")


@register(
    CATALOG,
    """
    SELECT l_orderkey, l_linenumber, round(greatest(l_discount * 10, 1 - l_discount * 10), 8) AS confidence FROM lineitem
    """,
)
def row_confidence(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("score"))
    return L.confidence(rows).select("l_orderkey", "l_linenumber", F.round("confidence", 8).alias("confidence"))


# One confusion matrix per supplier; some lack a class.
_MATRICES = """m AS (SELECT l_suppkey, count(*) FILTER (l_returnflag <> 'R' AND l_tax < 0.04) AS tn,
    count(*) FILTER (l_returnflag <> 'R' AND l_tax >= 0.04) AS fp, count(*) FILTER (l_returnflag = 'R' AND l_tax < 0.04) AS fn,
    count(*) FILTER (l_returnflag = 'R' AND l_tax >= 0.04) AS tp FROM lineitem GROUP BY 1)"""


def _matrices(t: Tables):
    actual, hit = F.col("l_returnflag") == "R", F.col("l_tax") >= 0.04
    cells = {"tn": ~actual & ~hit, "fp": ~actual & hit, "fn": actual & ~hit, "tp": actual & hit}
    return t.lineitem.groupBy("l_suppkey").agg(*[F.count(F.when(c, 1)).alias(n) for n, c in cells.items()])


@register(
    CATALOG,
    f"""WITH {_MATRICES},
    k AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
                 coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1 FROM m),
    f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
                 coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM k)
    SELECT l_suppkey, tn, fp, fn, tp, round((f0 + f1) / 2, 10) AS f1_macro, round(f1, 10) AS f1_minority FROM f""",
)
def f1_of_matrices(t):
    # All digits: a mean of two rounded numbers would end in a 5 too often to compare.
    got = L.f1_from_confusion(_matrices(t), digits=15)
    return got.withColumns({c: F.round(c, 10) for c in ("f1_macro", "f1_minority")})


@register(
    CATALOG,
    f"""WITH {_MATRICES}
    SELECT l_suppkey, tn, fp, fn, tp, tax AS average_precision,
           round_even((tn + fp) * 100.0::DOUBLE / (tn + fp + fn + tp), 1) AS majority_pct,
           round_even((fn + tp) * 100.0::DOUBLE / (tn + fp + fn + tp), 1) AS minority_pct,
           coalesce(round_even((tn + fp) / nullif(fn + tp, 0)::DOUBLE, 1), 0) AS minority_weight,
           round(tax * (tn + fp + fn + tp) / nullif(fn + tp, 0), 7) AS ap_lift
    FROM m JOIN (SELECT l_suppkey, min(l_tax) + 0.25 AS tax FROM lineitem GROUP BY 1) USING (l_suppkey)""",
)
def class_balance_of_matrices(t):
    ap = t.lineitem.groupBy("l_suppkey").agg((F.min("l_tax") + 0.25).alias("average_precision"))
    return L.class_balance(_matrices(t).join(ap, "l_suppkey")).withColumn("ap_lift", F.round("ap_lift", 7))


@register(
    CATALOG,
    f"""WITH a AS (SELECT avg(CAST((l_returnflag = 'R') = (l_tax >= 0.04) AS INTEGER)) AS x FROM lineitem WHERE l_linestatus = 'F'),
         b AS (SELECT avg(CAST((l_returnflag = 'R') = (l_tax >= 0.04) AS INTEGER)) AS x FROM lineitem WHERE l_linestatus <> 'F')
    SELECT round(a.x, 7) AS train_accuracy, round(b.x, 7) AS test_accuracy, round((a.x - b.x) * 100, 6) AS gap,
           CAST(abs((a.x - b.x) * 100) > 10 AS INTEGER) AS warning,
           CASE WHEN (a.x - b.x) * 100 >= 15 THEN 'high' WHEN (a.x - b.x) * 100 >= 5 THEN 'moderate' ELSE 'low' END AS gap_band
    FROM a, b""",
)
def accuracy_gap(t):
    rows = t.lineitem.select(
        "l_linestatus", flag(F.col("l_returnflag") == "R").alias("y"), flag(F.col("l_tax") >= 0.04).alias("p")
    )
    got = L.overfit_gap(rows.where("l_linestatus = 'F'"), rows.where("l_linestatus <> 'F'"), "y", "p")
    return got.withColumns({"train_accuracy": F.round("train_accuracy", 7), "test_accuracy": F.round("test_accuracy", 7), "gap": F.round("gap", 6)})


@register(
    CATALOG,
    f"""WITH {FINE}, g AS (SELECT 0.05 + i * ((0.95 - 0.05) / 299) AS threshold FROM (SELECT unnest(range(300))::DOUBLE AS i)),
    q AS (SELECT score, count(*) FILTER (y) AS pos, count(*) AS n FROM s GROUP BY 1),
    h AS (SELECT threshold, sum(pos) AS tp, sum(n) AS chosen FROM g JOIN q ON score >= threshold GROUP BY 1),
    f AS (SELECT *, 2 * tp / (chosen + (SELECT sum(pos) FROM q))::DOUBLE AS f1 FROM h)
    SELECT round(threshold, 9) AS threshold, round(f1, 9) AS f1, round(tp / chosen::DOUBLE, 9) AS precision,
           round(tp / (SELECT sum(pos) FROM q)::DOUBLE, 9) AS recall
    FROM f ORDER BY f1 DESC, threshold LIMIT 1""",
)
def threshold_by_grid(t):
    return _rounded(L.best_threshold(_fine(t), "y", "score"), 9)


@register(
    CATALOG,
    f"""WITH {FINE}{RANKED}, f AS (SELECT score AS threshold, 2 * cp / (cp + cn + p)::DOUBLE AS f1 FROM r)
    SELECT round(threshold, 9) AS threshold, round(f1, 9) AS f1 FROM f ORDER BY f.f1 DESC, f.threshold LIMIT 1""",
)
def threshold_among_scores(t):
    return _rounded(L.best_observed_threshold(_fine(t), "y", "score"), 9)


@register(
    CATALOG,
    """
    WITH m AS (SELECT l_returnflag AS f FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT 'majority_baseline' AS approach, round(avg(CAST(l_returnflag = f AS INTEGER)), 8) AS test_accuracy
    FROM lineitem, m WHERE l_linestatus = 'O' UNION ALL SELECT 'random_baseline', 0.5::DOUBLE
    """,
)
def baseline_accuracy(t):
    got = L.baseline_metrics(t.lineitem.where("l_linestatus = 'F'"), t.lineitem.where("l_linestatus = 'O'"), "l_returnflag")
    return _rounded(got, 8)


@register(
    CATALOG,
    f"""WITH {FINE}{RANKED},
    i AS (SELECT *, cp + cn - pos - neg < floor((p + n) * 0.2) AS inside FROM r)
    SELECT round(min(score), 8) AS cut_score, CAST(sum(pos + neg) AS BIGINT) AS rows_selected,
           CAST(sum(pos) AS BIGINT) AS positives_selected, CAST(max(p) AS BIGINT) AS positives,
           CAST(max(p + n) AS BIGINT) AS "rows", round(sum(pos) / max(p)::DOUBLE, 8) AS captured,
           round(sum(pos) / max(p)::DOUBLE * max(p + n) / sum(pos + neg), 8) AS lift
    FROM i WHERE inside""",
)
def positives_at_the_top(t):
    return _rounded(L.capture_at(_fine(t), "y", "score", 0.2), 8)


# ---------------------------------------------------------------- neighbours


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (SELECT a.vec_id AS id, b.vec_id AS ref_id, b.label, list_distance(a.v, b.v) AS distance
          FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, ref_id) AS rank FROM d)
    SELECT id, ref_id, label, round(distance, 8) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
    """,
)
def nearest_vectors(t):
    near = N.nearest(t.embeddings, t.embeddings, 5, "vec_id", "embedding", "label", skip_self=True)
    return near.withColumn("distance", F.round("distance", 8))


@register(
    CATALOG,
    """
    WITH e AS (SELECT p_partkey, p_size, [p_size, floor(p_retailprice / 8), p_partkey % 50]::DOUBLE[] AS v FROM part),
    d AS (SELECT a.p_partkey AS id, b.p_partkey AS ref_id, b.p_size AS label, list_distance(a.v, b.v) AS distance
          FROM e a JOIN e b ON a.p_partkey <> b.p_partkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, ref_id) AS rank FROM d)
    SELECT id, ref_id, label, round(distance, 8) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
    """,
)
def nearest_parts(t):
    """Rows of few dimensions, through the metric index."""
    place = F.array("p_size", F.floor(F.col("p_retailprice") / 8), F.pmod("p_partkey", F.lit(50))).cast("array<double>")
    rows = t.part.select("p_partkey", "p_size", place.alias("v"))
    near = N.nearest(rows, rows, 5, "p_partkey", "v", "p_size", skip_self=True, cell_rows=64)
    return near.withColumn("distance", F.round("distance", 8))


def _vote_sql(metric: str, vote: str, k: int) -> str:
    return f"""
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (SELECT a.vec_id AS id, b.vec_id AS ref_id, b.label, {metric} AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, ref_id) AS rank FROM d),
    v AS (SELECT id, label, sum({vote}) AS w FROM r WHERE rank <= {k} GROUP BY 1, 2),
    s AS (SELECT id, label, w / sum(w) OVER (PARTITION BY id) AS share FROM v),
    p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(share, 12) DESC, label) AS k FROM s)
    SELECT id, label AS prediction, round(share, 7) AS probability FROM p WHERE k = 1
    """


@register(CATALOG, _vote_sql("list_distance(a.v, b.v)", "1 / distance", 7))
def neighbour_vote_by_distance(t):
    got = N.knn_vote(t.embeddings, t.embeddings, 7, "vec_id", "embedding", "label", skip_self=True)
    return got.withColumn("probability", F.round("probability", 7))


@register(
    CATALOG,
    _vote_sql("list_sum(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))", "1.0::DOUBLE", 3),
)
def neighbour_vote_uniform_manhattan(t):
    got = N.knn_vote(
        t.embeddings, t.embeddings, 3, "vec_id", "embedding", "label", "uniform", "manhattan", skip_self=True
    )
    return got.withColumn("probability", F.round("probability", 7))


# ---------------------------------------------------------------- training

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def planted(t: Tables):
    """Order lines with a target that the columns tell, with noise from the key; :data:`PLANTED` in SQL."""
    noise = F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17, F.lit(1000)) / 1000.0
    signal = F.col("l_quantity") / 50 + F.col("l_discount") * 4 + noise * 0.8 > 1.2
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return t.lineitem.select(
        key.alias("key"), *[F.col(c).cast("double").alias(c) for c in FEATURES], flag(signal).alias("y")
    )


PLANTED = """planted AS (SELECT l_orderkey * 8 + l_linenumber AS key, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
      CAST(l_quantity / 50 + l_discount * 4 + (l_orderkey * 31 + l_linenumber * 17) % 1000 / 1000.0::DOUBLE * 0.8 > 1.2 AS INTEGER) AS y
    FROM lineitem)"""

@register(
    CATALOG,
    f"""
    WITH {PLANTED}, w AS (SELECT *, count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY y)) AS w, 2 * y - 1 AS r FROM planted),
    u AS (UNPIVOT (SELECT w, r, l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice,
                   l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax, l_linenumber::DOUBLE AS l_linenumber FROM w)
          ON l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber INTO NAME feature VALUE value),
    c AS (SELECT feature, value, count(*) AS n, sum(w) AS w, sum(w * r) AS s FROM u GROUP BY 1, 2),
    g AS (SELECT feature, value, lead(value) OVER o AS next, sum(n) OVER o AS nl, sum(n) OVER a AS na, sum(w) OVER o AS wl, sum(w) OVER a AS wa,
                 sum(s) OVER o AS sl, sum(s) OVER a AS sa FROM c
          WINDOW o AS (PARTITION BY feature ORDER BY value), a AS (PARTITION BY feature))
    SELECT feature, round((value + next) / 2, 6) AS threshold, CAST(nl AS BIGINT) AS rows_left,
           round((sl * sl / wl + (sa - sl) * (sa - sl) / (wa - wl) - sa * sa / wa) / wa, 8) AS gain
    FROM g WHERE next IS NOT NULL AND nl >= 30 AND na - nl >= 30
    """,
)
def gains_of_cuts(t):
    rows = T.balanced_weights(planted(t).withColumn("r", 2 * F.col("y") - 1), "y", "w")
    got = C.split_gains(rows, FEATURES, "r", "w", least_rows=30)
    return got.withColumns({"threshold": F.round("threshold", 6), "gain": F.round("gain", 8)})


def _product_terms_sql() -> str:
    scaled = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER () AS z{i}" for i, f in enumerate(FEATURES))
    terms = [(n, f"z{FEATURES.index(n)}" if " x " not in n else " * ".join(f"z{FEATURES.index(f)}" for f in n.split(" x "))) for n in Z.interaction_terms(FEATURES)]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS term, sum(w * y * {t}) / sum(w) AS moment FROM v" for n, t in [("constant", "1"), *terms])
    return f"""
    WITH {PLANTED}, z AS (SELECT y, {scaled} FROM planted),
    v AS (SELECT *, count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY y)) AS w FROM z)
    SELECT term, round(moment, 4) AS moment FROM ({rows})
    """


@register(CATALOG, _product_terms_sql())
def logistic_on_products(t):
    """The fit is at its optimum: for each term, what the probabilities and the penalty give is what the labels ask for."""
    rows = T.balanced_weights(planted(t), "y", "weight")
    model = Z.logistic_interactions(rows.drop("weight"), FEATURES, "y")
    got = C.logistic_optimality(model, rows, "y", "weight", Z.interaction_terms(FEATURES))
    return got.select("term", F.round("fitted", 4).alias("moment"))


@register(
    CATALOG,
    " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 5) AS f_score
        FROM (SELECT count(*) AS n, avg({f}) AS m, var_pop({f}) AS v, (SELECT avg({f}) FROM lineitem) AS g
              FROM lineitem GROUP BY l_returnflag)"""
        for f in FEATURES
    ),
)
def anova_scores(t):
    return Z.anova_f(t.lineitem, FEATURES, "l_returnflag").withColumn("f_score", F.round("f_score", 5))


@register(
    CATALOG,
    "SELECT feature FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS s
        FROM (SELECT count(*) AS n, avg({f}) AS m, var_pop({f}) AS v, (SELECT avg({f}) FROM lineitem) AS g
              FROM lineitem GROUP BY l_returnflag)"""
        for f in FEATURES
    )
    + ") ORDER BY s DESC, feature LIMIT 2",
)
def best_features(t):
    return Z.select_k_best(t.lineitem, FEATURES, "l_returnflag", 2).select("feature")


@register(CATALOG)
def model_comparison(t):
    return Z.compare_models(planted(t), FEATURES, "y", "key")


FOLD = "(key // 8 + 3 * (key % 8)) % 5"
#: Area under the curve of scores m against y, from ranks (a tie counts half), in rows that are grouped.
PLACED = "rank() OVER (PARTITION BY {by} ORDER BY m) + (count(*) OVER (PARTITION BY {by}, m) - 1) / 2.0::DOUBLE AS place"
AREA = "(sum(place) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y))::DOUBLE"


def fold_of_key():
    return F.pmod(F.floor(F.col("key") / 8) + 3 * F.pmod("key", F.lit(8)), F.lit(5)).cast("int")


@register(
    CATALOG,
    f"""
    WITH {PLANTED}, p AS (SELECT floor(l_quantity / 5) AS band, y, {FOLD} AS f FROM planted),
    r AS (SELECT g.f, band, avg(y) AS m FROM p JOIN (SELECT unnest(range(5)) AS f) AS g ON p.f <> g.f GROUP BY 1, 2),
    s AS (SELECT p.f, y, m, {PLACED.format(by="p.f")} FROM p JOIN r ON p.f = r.f AND p.band = r.band),
    k AS (SELECT f, avg(CAST((m > 0.5) = (y = 1) AS INTEGER)) AS accuracy, {AREA} AS roc_auc FROM s GROUP BY 1)
    SELECT count(*) AS folds, round(avg(accuracy), 6) AS cv_accuracy_mean, round(stddev_pop(accuracy), 6) AS cv_accuracy_std,
           round(avg(roc_auc), 6) AS cv_roc_auc_mean, round(stddev_pop(roc_auc), 6) AS cv_roc_auc_std FROM k
    """,
)
def folds_of_logistic(t):
    """Indicators of all levels but one, without a penalty: the fitted chances are the levels' own rates."""
    band = F.floor(F.col("l_quantity") / 5)
    levels = [f"band_{i}" for i in range(1, 11)]
    rows = planted(t).select("key", "y", fold_of_key().alias("fold"), *[flag(band == i).cast("double").alias(n) for i, n in enumerate(levels, 1)])

    def fit(part):
        return Z.fit_pipeline(part, levels, LogisticRegression(labelCol="y", maxIter=200, tol=1e-6), "y")

    got = Z.cv_summary(Z.cross_validate(rows, fit, "y", "key", fold="fold"))
    return got.select("folds", *[F.round(c, 6).alias(c) for c in got.columns if c != "folds"])


# Ridge weights by Cramer's rule: the matrix of standardised columns is (n - 1) times their correlations, plus the penalty.
_CLOSED = ("l_quantity", "l_discount", "l_tax")


def _closed_form_sql(penalty: float = 1.0) -> str:
    x, pairs = range(1, 4), ((1, 2), (1, 3), (2, 3))
    columns = ", ".join(f"{c}::DOUBLE AS x{i}" for i, c in zip(x, _CLOSED))
    stats = ["count(*) AS n", "avg(2 * y - 1) AS mt"]
    for i in x:
        stats += [f"avg(x{i}) AS m{i}", f"stddev_samp(x{i}) AS d{i}", f"covar_samp(x{i}, 2 * y - 1) AS b{i}", f"var_pop(x{i}) AS v{i}"]
        for y in (0, 1):
            stats += [f"avg(x{i}) FILTER (y = {y}) AS m{y}{i}", f"var_pop(x{i}) FILTER (y = {y}) AS v{y}{i}"]
    stats += [f"(count(*) - 1) * corr(x{i}, x{j}) AS a{i}{j}" for i, j in pairs]
    stats += ["count(*) FILTER (y = 1) AS n1", "count(*) FILTER (y = 0) AS n0"]

    def entry(i, j, column):
        if j == column:
            return f"((n - 1) * b{i} / d{i})"
        return f"(n - 1 + {penalty})" if i == j else f"a{min(i, j)}{max(i, j)}"

    def det(column):
        m = {(i, j): entry(i, j, column) for i in x for j in x}
        return " + ".join(
            f"{m[1, p]} * ({m[2, q]} * {m[3, r]} - {m[2, r]} * {m[3, q]})" for p, q, r in ((1, 2, 3), (2, 3, 1), (3, 1, 2))
        )

    weights = ", ".join(f"({det(i)}) / ({det(0)}) / d{i} AS w{i}" for i in x)
    ridge = "mt + " + " + ".join(f"(x{i} - m{i}) * w{i}" for i in x)
    extra = "1e-9 * greatest(v1, v2, v3)"
    bells = " - ".join(
        ["ln(n1 / n0)"]
        + [f"0.5 * (ln((v1{i} + e) / (v0{i} + e)) + (x{i} - m1{i}) ** 2 / (v1{i} + e) - (x{i} - m0{i}) ** 2 / (v0{i} + e))" for i in x]
    )
    return f"""
    WITH {PLANTED}, p AS (SELECT key, y, {columns}, {FOLD} AS f FROM planted),
    s AS (SELECT g.f, {", ".join(stats)} FROM p JOIN (SELECT unnest(range(5)) AS f) AS g ON p.f <> g.f GROUP BY g.f),
    w AS (SELECT *, {weights}, {extra} AS e FROM s),
    q AS (SELECT 'Ridge (penalty=1)' AS model, f, y, {ridge} AS m FROM p JOIN w USING (f)
          UNION ALL SELECT 'Gaussian Naive Bayes', f, y, {bells} FROM p JOIN w USING (f)),
    r AS (SELECT *, rank() OVER (PARTITION BY model, f ORDER BY m) + (count(*) OVER (PARTITION BY model, f, m) - 1) / 2 AS place FROM q)
    SELECT model, CAST(f AS INTEGER) AS fold, count(*) AS n, round(avg(CAST((m >= 0) = (y = 1) AS INTEGER)), 8) AS accuracy,
           round((sum(place) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y))::DOUBLE, 6) AS roc_auc
    FROM r GROUP BY 1, 2
    """


@register(CATALOG, _closed_form_sql())
def folds_in_closed_form(t):
    got = D.cross_validate_closed(planted(t).withColumn("fold", fold_of_key()), _CLOSED, "y", "fold")
    return got.withColumns({"accuracy": F.round("accuracy", 8), "roc_auc": F.round("roc_auc", 6)})


_MANHATTAN = "list_sum(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))"
_SETTINGS_SQL = " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, {k} AS n_neighbors, '{w}' AS weights, id, truth, f, label, sum({vote}) AS w FROM {metric} WHERE rank <= {k} GROUP BY ALL"
    for metric in ("euclidean", "manhattan")
    for k in (3, 5, 7)
    for w, vote in (("uniform", "1.0::DOUBLE"), ("distance", "1 / distance"))
)


@register(
    CATALOG,
    f"""
    WITH e AS (SELECT vec_id, label, vec_id % 5 AS f, embedding::DOUBLE[] AS v FROM embeddings),
    euclidean AS (SELECT a.vec_id AS id, a.label AS truth, a.f, b.label, list_distance(a.v, b.v) AS distance,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank FROM e a JOIN e b ON a.f <> b.f),
    manhattan AS (SELECT a.vec_id AS id, a.label AS truth, a.f, b.label, {_MANHATTAN} AS distance,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY {_MANHATTAN}, b.vec_id) AS rank FROM e a JOIN e b ON a.f <> b.f),
    v AS ({_SETTINGS_SQL}),
    s AS (SELECT *, w / sum(w) OVER (PARTITION BY metric, n_neighbors, weights, id) AS share FROM v),
    p AS (SELECT *, row_number() OVER (PARTITION BY metric, n_neighbors, weights, id ORDER BY round(share, 12) DESC, label) AS place FROM s),
    a AS (SELECT metric, n_neighbors, weights, f, avg(CAST(label = truth AS INTEGER)) AS a FROM p WHERE place = 1 GROUP BY 1, 2, 3, 4)
    SELECT metric, CAST(n_neighbors AS INTEGER) AS n_neighbors, weights, round(avg(a), 8) AS cv_accuracy_mean, round(stddev_pop(a), 8) AS cv_accuracy_std
    FROM a GROUP BY 1, 2, 3
    """,
)
def neighbour_settings(t):
    rows = t.embeddings.withColumn("fold", F.pmod("vec_id", F.lit(5)))
    got = Z.knn_grid(rows, "vec_id", "embedding", "label", fold="fold")
    return got.withColumns({c: F.round(c, 8) for c in ("cv_accuracy_mean", "cv_accuracy_std")})


_PART_Y = "CAST(p_size * 20 + p_partkey * 7 % 400 > 700 AS INTEGER)"


@register(
    CATALOG,
    f"""
    WITH e AS (SELECT p_partkey AS id, p_type, p_size, {_PART_Y} AS y, [p_size, floor(p_retailprice / 8), p_partkey % 50]::DOUBLE[] AS v FROM part),
    a AS (SELECT p_type, avg(y) AS p FROM e GROUP BY 1),
    c AS (SELECT p_size, count(*) AS n, sum(y) AS s FROM e GROUP BY 1),
    g AS (SELECT p_size, lead(p_size) OVER o AS next, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s
          FROM c WINDOW o AS (ORDER BY p_size)),
    b AS (SELECT * FROM g WHERE next IS NOT NULL ORDER BY sl * sl / nl::DOUBLE + (s - sl) * (s - sl) / (n - nl)::DOUBLE DESC LIMIT 1),
    d AS (SELECT a.id, b.y, list_distance(a.v, b.v) AS distance, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
          FROM e a JOIN e b ON a.id <> b.id),
    w AS (SELECT id, min(distance) = 0 AS exact, sum(y * CASE WHEN distance = 0 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN distance = 0 THEN 1 ELSE 0 END), 0) AS at0,
                 sum(y / nullif(distance, 0)) / sum(1 / nullif(distance, 0)) AS far FROM d WHERE rank <= 5 GROUP BY 1),
    z AS (SELECT e.id, (a.p + CASE WHEN e.p_size <= b.p_size THEN sl / nl ELSE (s - sl) / (n - nl) END + CASE WHEN exact THEN at0 ELSE far END) / 3 AS p1
          FROM e JOIN a USING (p_type) JOIN w USING (id), b)
    SELECT id, round(p1, 4) AS p1, CAST(p1 > 0.5 AS INTEGER) AS prediction FROM z
    """,
)
def vote_of_models(t):
    """Three kinds of model: logistic regression on levels, a tree of one cut, and a vote of near rows."""
    place = F.array("p_size", F.floor(F.col("p_retailprice") / 8), F.pmod("p_partkey", F.lit(50))).cast("array<double>")
    types = sorted(r[0] for r in t.part.select("p_type").distinct().collect())
    rows = t.part.select(
        F.col("p_partkey").alias("id"),
        F.expr(_PART_Y.replace("INTEGER", "INT")).alias("y"),
        F.col("p_size").cast("double").alias("size"),
        place.alias("v"),
        *[flag(F.col("p_type") == level).cast("double").alias(f"type_{i}") for i, level in enumerate(types[1:])],
    )
    levels = [c for c in rows.columns if c.startswith("type_")]
    near = N.label_shares(N.nearest(rows, rows, 5, "id", "v", "y", skip_self=True, cell_rows=64)).where("label = 1")
    # Written, so that no pass of a fit joins the votes again.
    rows = written(rows.join(near.select(F.col("id").alias("_id"), "share"), F.col("id") == F.col("_id"), "left").fillna(0.0, ["share"]))
    models = [
        Z.fit_pipeline(rows, levels, LogisticRegression(labelCol="y", maxIter=200, tol=1e-9), "y"),
        Z.fit_pipeline(rows.withColumn("y", F.col("y").cast("double")), ["size"], DecisionTreeClassifier(labelCol="y", maxDepth=1, maxBins=64), "y"),
    ]
    return Z.soft_vote(rows, models, extra=["share"]).select("id", F.round("p1", 4).alias("p1"), "prediction")


@register(CATALOG)
def training_approaches(t):
    return Z.approach_comparison(planted(t), FEATURES, "y", "key", extra_rows=1000, trees=10)
