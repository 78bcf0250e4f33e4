"""Queries on grouping of rows, its measures and reports."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chartmill.catalog.base import Query, Tables, register
from chartmill.functions import flag
from chartmill.operators import clusters as K
from chartmill.operators import distance_bounds as B

CATALOG: dict[str, Query] = {}

COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _lines(t: Tables):
    rows = t.lineitem.withColumn("l_quantity", F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")))
    return rows.select("l_orderkey", "l_linenumber", *COLS)


@register(
    CATALOG,
    """
    WITH h AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS q,
                      l_extendedprice AS e, l_discount AS d FROM lineitem),
    f AS (SELECT l_orderkey, l_linenumber, coalesce(q, (SELECT quantile_cont(q, 0.5) FROM h)) AS q, ln(1 + e) AS e, d FROM h),
    m AS (SELECT avg(q) qm, stddev_pop(q) qs, avg(e) em, stddev_pop(e) es, avg(d) dm, stddev_pop(d) ds FROM f)
    SELECT l_orderkey, l_linenumber, round((q - qm) / qs, 6) AS l_quantity_z, round((e - em) / es, 6) AS l_extendedprice_z,
           round((d - dm) / ds, 6) AS l_discount_z FROM f, m
    """,
)
def scaled_cluster_inputs(t):
    got = K.cluster_features(_lines(t), COLS, log_cols=["l_extendedprice"], vector=None)
    return got.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in COLS])


@register(
    CATALOG,
    """
    WITH h AS (SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END, 0.0) AS q
               FROM lineitem)
    SELECT l_orderkey, l_linenumber, round((q - (SELECT avg(q) FROM h)) / (SELECT stddev_pop(q) FROM h), 6) AS l_quantity_z FROM h
    """,
)
def zero_filled_cluster_inputs(t):
    got = K.cluster_features(_lines(t), ["l_quantity"], fill="zero", vector=None)
    return got.select("l_orderkey", "l_linenumber", F.round("l_quantity_z", 6).alias("l_quantity_z"))


def _planted(t: Tables):
    """Vectors around three far-apart centres, told by the row key."""
    group = F.pmod(F.col("vec_id"), F.lit(3)).cast("int")
    shifted = F.transform(
        F.col("embedding").cast("array<double>"), lambda x, i: x + F.when(F.pmod(i, F.lit(3)) == group, 4.0).otherwise(0.0)
    )
    return t.embeddings.select("vec_id", group.alias("group"), array_to_vector(shifted).alias("features"))


@register(
    CATALOG, "SELECT CAST(vec_id % 3 AS INTEGER) AS \"group\", count(*) AS n, CAST(1 AS BIGINT) AS clusters FROM embeddings GROUP BY 1"
)
def planted_groups_found(t):
    found = K.kmeans_assign(_planted(t), 3)
    return found.groupBy("group").agg(F.count("*").alias("n"), F.count_distinct("cluster").alias("clusters"))


@register(
    CATALOG,
    """
    WITH y AS (SELECT l_suppkey % 3 AS g, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
    b AS (SELECT avg(y) * 100 AS base, count(*) AS total FROM y), g AS (SELECT g, count(*) AS n, avg(y) * 100 AS r FROM y GROUP BY 1)
    SELECT n, round(r, 8) AS rate_pct, round(n * 100.0::DOUBLE / total, 8) AS pct_of_total,
           CAST(row_number() OVER (ORDER BY r DESC) AS INTEGER) AS "rank",
           CASE WHEN r >= base * 1.5 THEN 'High' WHEN r >= base THEN 'Elevated' ELSE 'Low' END AS risk_tier FROM g, b
    """,
)
def clusters_of_lines(t):
    """Scaled columns, groups found by K-Means, and their report; each supplier group lies elsewhere."""
    apart = F.pmod(F.col("l_suppkey"), F.lit(3)) * 200
    rows = t.lineitem.select("l_quantity", (F.col("l_discount") * 100 + apart).alias("place"), "l_tax", "l_returnflag")
    rows = K.cluster_features(rows, ["l_quantity", "place", "l_tax"])
    heavy = F.transform(vector_to_array("features"), lambda x, i: x * F.when(i == 1, 9.0).otherwise(1.0))
    rows = rows.withColumns({"features": array_to_vector(heavy), "y": flag(F.col("l_returnflag") == "R")})
    got = K.cluster_report(K.kmeans_assign(rows, 3), "cluster", "y").drop("cluster")
    return got.withColumns({"rate_pct": F.round("rate_pct", 8), "pct_of_total": F.round("pct_of_total", 8)})


# The planted groups are optimal for k = 3, and the cheapest merger of two of them for k = 2.
_PLANTED_SQL = """
    WITH e AS (SELECT vec_id % 3 AS g, i, x + CASE WHEN i % 3 = vec_id % 3 THEN 4.0 ELSE 0.0 END AS x
               FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)),
    c AS (SELECT g, i, avg(x) AS m, count(*) AS n FROM e GROUP BY 1, 2),
    t AS (SELECT sum((x - m) * (x - m)) AS inertia FROM e JOIN c USING (g, i)),
    a AS (SELECT a.g, b.g, max(a.n * b.n / (a.n + b.n)::DOUBLE) * sum((a.m - b.m) * (a.m - b.m)) AS more
          FROM c AS a JOIN c AS b ON a.i = b.i AND a.g < b.g GROUP BY 1, 2)"""


@register(
    CATALOG,
    _PLANTED_SQL
    + """
    SELECT CAST(k AS INTEGER) AS k, CASE k WHEN 2 THEN round(inertia + (SELECT min(more) FROM a), 4) WHEN 3 THEN round(inertia, 4) END AS inertia,
           CAST(k = 3 AS INTEGER) AS best FROM t, (SELECT unnest(range(2, 9)) AS k)
    """,
)
def elbow_scan(t):
    """All of the scan's settings; sums beyond the planted number of groups depend on the starts and are left out."""
    scan = K.k_scan(_planted(t), "vec_id")
    return scan.select("k", F.when(F.col("k") <= 3, F.round("inertia", 4)).alias("inertia"), "best")


@register(CATALOG, _PLANTED_SQL + " SELECT CAST(3 AS INTEGER) AS k, round(inertia, 4) AS inertia, CAST(1 AS INTEGER) AS best FROM t")
def elbow_at_planted_groups(t):
    return K.k_scan(_planted(t), "vec_id").where("k = 3").select("k", F.round("inertia", 4).alias("inertia"), "best")


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2)
    SELECT round(sum((x - m) * (x - m)), 6) AS inertia FROM e JOIN c USING (label, i)
    """,
)
def inertia_of_labels(t):
    return K.inertia(t.embeddings, "embedding", "label").withColumn("inertia", F.round("inertia", 6))


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    n AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s FROM e a JOIN e b ON true GROUP BY ALL),
    r AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
          FROM d JOIN n ON d.other = n.label GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 3) AS silhouette, CAST(1 AS INTEGER) AS proven FROM r
    """,
)
def silhouette_within_error(t):
    """The same from bounds, in passes over the rows; its proven error is a hundredth, its actual one far smaller."""
    got = B.silhouette_within(t.embeddings, "embedding", "label", 0.01)
    return got.select(F.round("silhouette", 3).alias("silhouette"), flag(F.col("error") <= 0.01).alias("proven"))


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    n AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s FROM e a JOIN e b ON true GROUP BY ALL),
    r AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
          FROM d JOIN n ON d.other = n.label GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 8) AS silhouette FROM r
    """,
)
def silhouette_of_labels(t):
    got = K.silhouette(t.embeddings, "vec_id", "embedding", "label")
    return got.withColumn("silhouette", F.round("silhouette", 8))


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    n AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v) * list_distance(a.v, b.v)) AS s
          FROM e a JOIN e b ON true GROUP BY ALL),
    r AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
          FROM d JOIN n ON d.other = n.label GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 7) AS silhouette_squared FROM r
    """,
)
def squared_silhouette_of_labels(t):
    got = K.silhouette_squared(t.embeddings, "embedding", "label")
    return got.withColumn("silhouette_squared", F.round("silhouette_squared", 7))


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
    r AS (SELECT label, vec_id, sqrt(sum((x - m) * (x - m))) AS d FROM e JOIN c USING (label, i) GROUP BY 1, 2),
    s AS (SELECT label, avg(d) AS s FROM r GROUP BY 1),
    p AS (SELECT a.label AS x, b.label AS y, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d
          FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
    w AS (SELECT x, max((s1.s + s2.s) / d) AS w FROM p JOIN s s1 ON s1.label = x JOIN s s2 ON s2.label = y GROUP BY 1)
    SELECT round(avg(w), 7) AS davies_bouldin FROM w
    """,
)
def davies_bouldin_of_labels(t):
    got = K.davies_bouldin(t.embeddings, "embedding", "label")
    return got.withColumn("davies_bouldin", F.round("davies_bouldin", 7))


@register(
    CATALOG,
    """
    WITH z AS (SELECT l_orderkey, l_linenumber, corr(l_quantity, l_extendedprice) OVER () AS r,
                 (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
                 (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(greatest(abs(a + b) * CAST(r > 0 AS INTEGER), abs(a - b) * CAST(r <= 0 AS INTEGER)) / sqrt(2), 5) AS pc1,
           round(greatest(abs(a - b) * CAST(r > 0 AS INTEGER), abs(a + b) * CAST(r <= 0 AS INTEGER)) / sqrt(2), 5) AS pc2,
           round((1 + abs(r)) / 2, 8) AS pc1_variance, round((1 - abs(r)) / 2, 8) AS pc2_variance FROM z
    """,
)
def projected_lines(t):
    """Two scaled columns: the components are their sum and their difference, told up to the sign."""
    rows = K.cluster_features(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    got = K.pca_project(rows, 2)
    return got.select(
        "l_orderkey",
        "l_linenumber",
        *[F.round(F.abs(c), 5).alias(c) for c in ("pc1", "pc2")],
        *[F.round(c, 8).alias(c) for c in ("pc1_variance", "pc2_variance")],
    )


@register(
    CATALOG,
    """
    WITH e AS (SELECT vec_id % 3 AS g, i, x + CASE WHEN i % 3 = vec_id % 3 THEN 4.0 ELSE 0.0 END AS x
               FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)),
    c AS (SELECT g, i, avg(x) AS m FROM e GROUP BY 1, 2)
    SELECT CAST(a.g AS INTEGER) AS a, CAST(b.g AS INTEGER) AS b, round(sqrt(sum((a.m - b.m) * (a.m - b.m))), 6) AS apart
    FROM c AS a JOIN c AS b ON a.i = b.i AND a.g < b.g GROUP BY 1, 2
    """,
)
def projected_centroids(t):
    """Three centres span a plane, so their distances in it are those in all dimensions."""
    rows = _planted(t)
    model = K.fit_kmeans(rows, 3)
    # Components of the centres alone, which hold all that is between them.
    centres = t.spark.createDataFrame([(Vectors.dense(c),) for c in model.clusterCenters()], ["features"])
    placed = K.project_centroids(model, K.fit_pca(centres), rows)
    owner = model.setPredictionCol("cluster").transform(rows).groupBy("cluster").agg(F.min("group").alias("g"))
    found = placed.join(owner, "cluster").agg(F.collect_list(F.struct("g", "pc1", "pc2")).alias("all"))  # three
    pairs = found.select("all", F.explode("all").alias("x"))
    pairs = pairs.select("x", F.explode(F.filter("all", lambda y: y["g"] > F.col("x.g"))).alias("y"))
    apart = F.sqrt((F.col("x.pc1") - F.col("y.pc1")) ** 2 + (F.col("x.pc2") - F.col("y.pc2")) ** 2)
    return pairs.select(F.col("x.g").alias("a"), F.col("y.g").alias("b"), F.round(apart, 6).alias("apart"))


_REPORT = """
    WITH y AS (SELECT l_linenumber, CASE WHEN l_returnflag = 'R' AND l_quantity > 7 * l_linenumber THEN 1 ELSE 0 END AS y FROM lineitem),
    b AS (SELECT avg(y) * 100 AS base, count(*) AS total FROM y),
    g AS (SELECT l_linenumber, count(*) AS n, avg(y) * 100 AS r FROM y GROUP BY 1)
"""


def _ranked_lines(t: Tables):
    hit = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > F.col("l_linenumber") * 7)
    return t.lineitem.withColumn("y", flag(hit))


@register(
    CATALOG,
    _REPORT
    + """
    SELECT l_linenumber, n, round(r, 8) AS rate_pct, round(n * 100.0::DOUBLE / total, 8) AS pct_of_total,
           CAST(row_number() OVER (ORDER BY r DESC, l_linenumber) AS INTEGER) AS "rank",
           CASE WHEN r >= base * 1.5 THEN 'High' WHEN r >= base THEN 'Elevated' ELSE 'Low' END AS risk_tier
    FROM g, b
    """,
)
def report_of_groups(t):
    got = K.cluster_report(_ranked_lines(t), "l_linenumber", "y")
    return got.withColumns({"rate_pct": F.round("rate_pct", 8), "pct_of_total": F.round("pct_of_total", 8)})


@register(CATALOG, _REPORT + " SELECT round(max(r) - min(r), 7) AS rate_spread FROM g")
def rate_spread_of_groups(t):
    got = K.rate_spread(K.cluster_report(_ranked_lines(t), "l_linenumber", "y"))
    return got.withColumn("rate_spread", F.round("rate_spread", 7))


@register(
    CATALOG,
    """
    SELECT l_linenumber, count(*) FILTER (l_returnflag = 'A') AS "A", count(*) FILTER (l_returnflag = 'N') AS "N",
           count(*) FILTER (l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1
    """,
)
def composition_of_groups(t):
    return K.cluster_composition(t.lineitem, "l_linenumber", "l_returnflag", ["A", "N", "R"])


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    CATALOG,
    " UNION ALL ".join(
        f"""
        SELECT l_linenumber, '{c}' AS feature, round(avg({c}), 6) AS mean,
               round((avg({c}) - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem), 6) AS z
        FROM lineitem GROUP BY 1
        """
        for c in _PROFILED
    ),
)
def profile_of_groups(t):
    got = K.cluster_profile(t.lineitem, "l_linenumber", _PROFILED)
    return got.withColumns({"mean": F.round("mean", 6), "z": F.round("z", 6)})
