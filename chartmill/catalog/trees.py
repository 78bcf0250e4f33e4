"""Queries on boosted trees, against the same boosting written in SQL.

Both sides take columns with few values, so that every value's midpoint is a candidate cut, all rows and all columns for each
tree. The SQL boosts over groups of equal rows: each stage looks for the best cut of the residuals, then for the best one on
either side of it, and adds the sides' means.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from chartmill.catalog.base import Query, Tables, register
from chartmill.catalog.learning import FOLD, PLANTED, fold_of_key, planted
from chartmill.operators import fit_checks as C
from chartmill.operators import metrics as L
from chartmill.operators import models as Z
from chartmill.operators import sampling as T

CATALOG: dict[str, Query] = {}

COLUMNS = {"quantity_band": "floor(l_quantity / 5)", "l_discount": "l_discount", "l_tax": "l_tax", "l_linenumber": "l_linenumber"}
TREES, STEP, LEAST = 10, 0.2, 30
CONFIG = Z.BoostConfig(trees=TREES, step=STEP, depth=2, min_leaf=LEAST, row_share=1.0, feature_subset="all")


def _rows(t: Tables):
    return planted(t).select("key", "y", *[F.expr(e).cast("double").alias(n) for n, e in COLUMNS.items()])


def _train(t: Tables):
    return _rows(t).where("key % 5 <> 0")


def _best_cut(source: str, node: str, least: int = LEAST) -> str:
    """Per node of ``source`` (cells with n, w, r): the cut that takes most of the residuals' variance."""
    names = ", ".join(f"'{n}'" for n in COLUMNS)
    return f"""SELECT node, arg_max((feature, (value + next) / 2), gain) AS cut, max(gain) AS gain FROM (
        SELECT *, sl * sl / wl + (sa - sl) * (sa - sl) / (wa - wl) - sa * sa / wa AS gain FROM (
          SELECT node, feature, value, lead(value) OVER o AS next, sum(n) OVER o AS nl, sum(n) OVER a AS na, sum(w) OVER o AS wl,
                 sum(w) OVER a AS wa, sum(s) OVER o AS sl, sum(s) OVER a AS sa
          FROM (SELECT node, feature, value, sum(n) AS n, sum(w) AS w, sum(w * r) AS s
                FROM (SELECT {node} AS node, n, w, r, unnest([{names}]) AS feature, unnest([{", ".join(COLUMNS)}]) AS value FROM {source} WHERE n > 0)
                GROUP BY 1, 2, 3)
          WINDOW o AS (PARTITION BY node, feature ORDER BY value), a AS (PARTITION BY node, feature))
        WHERE next IS NOT NULL AND nl >= {least} AND na - nl >= {least})
      WHERE gain > 0 GROUP BY node"""


def _beyond(cut: str) -> str:
    return f"(CASE {cut}[1] " + " ".join(f"WHEN '{n}' THEN {n}" for n in COLUMNS) + f" END > {cut}[2])"


def _boosting_sql() -> str:
    columns = ", ".join(f"({e})::DOUBLE AS {n}" for n, e in COLUMNS.items())
    keys = ", ".join(COLUMNS)
    with_ = [
        PLANTED,
        f"""rows_ AS (SELECT p.key, p.y, {columns} FROM planted AS p)""",
        """weights AS (SELECT y, sum(count(*)) OVER () / (2.0::DOUBLE * count(*)) AS w FROM rows_ WHERE key % 5 <> 0 GROUP BY y)""",
        f"""f0 AS MATERIALIZED (SELECT {keys}, y, sum(CAST(key % 5 <> 0 AS INTEGER)) AS n, sum(CASE WHEN key % 5 <> 0 THEN w ELSE 0 END) AS w,
              sum(CAST(key % 5 = 0 AS INTEGER)) AS held, 0.0::DOUBLE AS f FROM rows_ JOIN weights USING (y) GROUP BY {keys}, y)""",
    ]
    for i in range(TREES):
        residual = "2 * y - 1" if i == 0 else "4 * (2 * y - 1) / (1 + exp(2 * (2 * y - 1) * f))"
        with_ += [
            f"s{i} AS MATERIALIZED (SELECT *, ({residual})::DOUBLE AS r FROM f{i})",
            f"a{i} AS MATERIALIZED ({_best_cut(f's{i}', '1')})",
            f"t{i} AS MATERIALIZED (SELECT s.*, CASE WHEN {_beyond('cut')} THEN 3 ELSE 2 END AS side FROM s{i} AS s, a{i})",
            f"b{i} AS MATERIALIZED ({_best_cut(f't{i}', 'side')})",
            f"""e{i} AS MATERIALIZED (SELECT t.*, CASE WHEN b.cut IS NULL THEN side ELSE 2 * side + CAST({_beyond('b.cut')} AS INTEGER) END AS leaf
                  FROM t{i} AS t LEFT JOIN b{i} AS b ON side = b.node)""",
            f"m{i} AS MATERIALIZED (SELECT leaf, sum(w * r) / sum(w) AS mean FROM e{i} GROUP BY leaf)",
            f"""f{i + 1} AS MATERIALIZED (SELECT {keys}, y, n, w, held, f + {1.0 if i == 0 else STEP}::DOUBLE * mean AS f FROM e{i} JOIN m{i} USING (leaf))""",
        ]
    return "WITH " + ",\n".join(with_)


BOOSTING = _boosting_sql()


@register(
    CATALOG,
    f"""{BOOSTING},
    q AS (SELECT f, sum(held) FILTER (y = 1) AS pos, sum(held) FILTER (y = 0) AS neg FROM f{TREES} GROUP BY f),
    z AS (SELECT f, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM q),
    k AS (SELECT *, sum(pos) OVER (ORDER BY f DESC) AS above FROM z)
    SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(neg) FILTER (f <= 0) AS BIGINT) AS tn, CAST(sum(neg) FILTER (f > 0) AS BIGINT) AS fp,
           CAST(sum(pos) FILTER (f <= 0) AS BIGINT) AS fn, CAST(sum(pos) FILTER (f > 0) AS BIGINT) AS tp,
           round(sum(neg * (above - pos / 2)) / (sum(pos) * sum(neg))::DOUBLE, 6) AS roc_auc,
           round(sum((pos + neg) / (1 + exp(-2 * f))) / sum(pos + neg), 6) AS mean_score
    FROM k""",
)
def boosted_trees_metrics(t):
    model = Z.train_gbt(_train(t), list(COLUMNS), "y", CONFIG)
    got = L.binary_metrics(Z.score(model, _rows(t).where("key % 5 = 0")), "y", "p1", "prediction")
    return got.select("n", "tn", "fp", "fn", "tp", F.round("roc_auc", 6).alias("roc_auc"), F.round("mean_score", 6).alias("mean_score"))


@register(
    CATALOG,
    f"""{BOOSTING}, c AS (SELECT DISTINCT {", ".join(COLUMNS)}, f FROM f{TREES})
    SELECT key, CAST(f > 0 AS INTEGER) AS prediction, round(1 / (1 + exp(2 * f)), 6) AS p0, round(1 / (1 + exp(-2 * f)), 6) AS p1,
           CASE WHEN f > 0 THEN 'Early Readmission Risk' ELSE 'Low Readmission Risk' END AS label_text,
           round_even(100 / (1 + exp(2 * f)), 1) AS low_risk_pct, round_even(100 / (1 + exp(-2 * f)), 1) AS high_risk_pct
    FROM rows_ JOIN c USING ({", ".join(COLUMNS)})""",
)
def batch_scores(t):
    model = Z.train_gbt(_train(t), list(COLUMNS), "y", CONFIG)
    scored = Z.score_batch(model, _rows(t)).drop("y", *COLUMNS)
    return scored.withColumns({"p0": F.round("p0", 6), "p1": F.round("p1", 6)})


@register(
    CATALOG,
    f"""{BOOSTING},
    g AS ({" UNION ALL ".join(f"SELECT cut[1] AS feature, gain FROM {x}{i}" for i in range(TREES) for x in "ab")}),
    h AS (SELECT feature, gain / sum(gain) OVER () AS share FROM g)
    SELECT feature, round(sum(share), 6) AS importance FROM h GROUP BY feature""",
)
def tree_importances(t):
    model = Z.train_gbt(_train(t), list(COLUMNS), "y", CONFIG)
    got = Z.feature_importance(model, t.lineitem, list(COLUMNS))
    return got.where("importance > 0").withColumn("importance", F.round("importance", 6))


@register(
    CATALOG,
    f"""WITH {BOOSTING.removeprefix("WITH ").split("f1 AS MATERIALIZED")[0].rstrip().rstrip(",")}
    SELECT cut[1] AS feature, round(cut[2], 6) AS threshold, round(gain / (SELECT sum(w) FROM s0), 8) AS gain,
           round(gain / (SELECT sum(w) FROM s0), 8) AS best_gain FROM a0""",
)
def root_of_boosted_trees(t):
    rows = T.balanced_weights(_train(t).withColumn("r", 2 * F.col("y") - 1), "y", "w")
    model = Z.train_gbt(_train(t), list(COLUMNS), "y", CONFIG)
    got = C.root_check(model, rows, list(COLUMNS), "r", "w")
    return got.select("feature", *[F.round(c, d).alias(c) for c, d in (("threshold", 6), ("gain", 8), ("best_gain", 8))])


DEPTHS, LEAVES = (1, 2), (1, 4000)


def _tree_settings_sql() -> str:
    """Trees of one and two levels per fold; the variance of a class is half its Gini impurity, so cuts are the same."""
    columns = ", ".join(f"({e})::DOUBLE AS {n}" for n, e in COLUMNS.items())
    keys = ", ".join(COLUMNS)
    with_ = [
        PLANTED,
        f"rows_ AS (SELECT y, {FOLD} AS f, {columns} FROM planted)",
        f"""cells AS MATERIALIZED (SELECT g.f, {keys}, y, y::DOUBLE AS r, sum(CAST(rows_.f <> g.f AS INTEGER)) AS n,
              sum(CAST(rows_.f <> g.f AS INTEGER))::DOUBLE AS w, sum(CAST(rows_.f = g.f AS INTEGER)) AS held
            FROM rows_, (SELECT unnest(range(5)) AS f) AS g GROUP BY g.f, {keys}, y)""",
    ]
    scored = []
    for least in LEAVES:
        with_ += [
            f"a{least} AS MATERIALIZED ({_best_cut('cells', 'f', least)})",
            f"""t{least} AS MATERIALIZED (SELECT c.*, CASE WHEN cut IS NULL THEN 10 * f + 1 WHEN {_beyond('cut')} THEN 10 * f + 3 ELSE 10 * f + 2 END AS side
                FROM cells AS c LEFT JOIN a{least} AS a ON f = a.node)""",
            f"b{least} AS MATERIALIZED ({_best_cut(f't{least}', 'side', least)})",
            f"""e{least} AS MATERIALIZED (SELECT t.*, CASE WHEN b.cut IS NULL OR side % 10 = 1 THEN 100 * side ELSE 100 * side + 1 + CAST({_beyond('b.cut')} AS INTEGER) END AS leaf
                FROM t{least} AS t LEFT JOIN b{least} AS b ON side = b.node)""",
        ]
        rate = "(sum(n) FILTER (y = 1) OVER (PARTITION BY {0}) / sum(n) OVER (PARTITION BY {0})::DOUBLE)"
        # Siblings that tell the same class become one leaf.
        with_ += [
            f"""r{least} AS MATERIALIZED (SELECT *, coalesce({rate.format("f")}, 0) AS m0, coalesce({rate.format("side")}, 0) AS m1,
                coalesce({rate.format("leaf")}, 0) AS m2 FROM e{least})""",
            f"""p{least} AS MATERIALIZED (SELECT *, min(m1 > 0.5) OVER s = max(m1 > 0.5) OVER s AS one, min(m2 > 0.5) OVER t = max(m2 > 0.5) OVER t AS same
                FROM r{least} WINDOW s AS (PARTITION BY f), t AS (PARTITION BY side))""",
        ]
        deep = "CASE WHEN NOT same THEN m2 WHEN one AND min(same) OVER (PARTITION BY f) THEN m0 ELSE m1 END"
        for depth, m in zip(DEPTHS, ("CASE WHEN one THEN m0 ELSE m1 END", deep)):
            scored.append(f"SELECT {depth} AS depth, {least} AS least, f, y, held, {m} AS m FROM p{least}")
    return "WITH " + ",\n".join(with_) + f""",
    q AS ({" UNION ALL ".join(scored)}),
    z AS (SELECT depth, least, f, coalesce(m, 0) AS m, sum(held) FILTER (y = 1) AS pos, sum(held) FILTER (y = 0) AS neg FROM q GROUP BY 1, 2, 3, 4),
    k AS (SELECT depth, least, f, m, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg, sum(coalesce(pos, 0)) OVER (PARTITION BY depth, least, f ORDER BY m DESC) AS above FROM z),
    o AS (SELECT depth, least, f, (coalesce(sum(pos) FILTER (m > 0.5), 0) + coalesce(sum(neg) FILTER (m <= 0.5), 0)) / sum(pos + neg)::DOUBLE AS accuracy,
            sum(neg * (above - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE AS roc_auc FROM k GROUP BY 1, 2, 3)
    SELECT CAST(depth AS INTEGER) AS depth, CAST(least AS INTEGER) AS least, round(avg(accuracy), 7) AS cv_accuracy_mean, round(avg(roc_auc), 7) AS cv_roc_auc_mean
    FROM o GROUP BY 1, 2"""


@register(CATALOG, _tree_settings_sql())
def tree_settings(t):
    tree = DecisionTreeClassifier(seed=42)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, list(DEPTHS)).addGrid(tree.minInstancesPerNode, list(LEAVES)).build()
    rows = _rows(t).withColumn("fold", fold_of_key())
    got = Z.grid_search(rows, list(COLUMNS), "y", "key", tree, grid, fold="fold")
    params = {"depth": "maxDepth", "least": "minInstancesPerNode"}
    return got.select(
        *[F.col("params")[p].cast("int").alias(n) for n, p in params.items()],
        *[F.round(c, 7).alias(c) for c in ("cv_accuracy_mean", "cv_roc_auc_mean")],
    )
