"""Exact distances between two sets of vectors: neighbours through a metric index, sums block against block.

References of more rows than one block are searched through :mod:`chartmill.operators.metric_index`. Otherwise, and
where all pairs count, both sides are cut by key hash into blocks of bounded size. Every query block meets every reference
block in a task of its own, which multiplies two matrices and hands on only a reduced result (the k
nearest, or sums per cluster), never the pairs. Blocks have a given number of rows, so that tasks stay the same size as the
tables grow, or are a fixed number until memory asks for more, so that the rows moved follow the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import col_of
from chartmill.operators.metric_index import CELL_ROWS, TILE, MetricIndex, best_in_block, grid_parts, id_codes, matrix, rough_distances
from chartmill.workers import ship

BLOCK_ROWS = 4096


def _usable(vec):
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _vector(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return col_of(name).cast("array<double>")
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(col_of(name))


def _blocks(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / block_rows))


def block_pairs(
    queries: DataFrame,
    refs: DataFrame,
    reduce_block: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``reduce_block(query rows, reference rows)`` to each pair of blocks.

    Both tables have the columns ``id`` and ``vec``; ``refs`` may have more. Without ``block_rows`` there are
    :data:`metric_index.GRID` blocks of each, more only where a block's vectors would not fit in memory.
    """
    ship(queries.sparkSession)
    if block_rows is None:
        dims = refs.agg(F.max(F.size("vec"))).first()[0] or 1
        n_q, n_r = (grid_parts(df.count(), dims) for df in (queries, refs))
    else:
        n_q, n_r = _blocks(queries.count(), block_rows), _blocks(refs.count(), block_rows)
    names = [part.split()[0] for part in schema.split(", ")]

    def place(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(columns=names) if q.empty or r.empty else reduce_block(q, r)

    left, right = place(queries, "_qb", n_q, "_rb", n_r), place(refs, "_rb", n_r, "_qb", n_q)
    if block_rows is None:
        # Few rows with much work: a number of partitions that is given is not merged by size.
        left, right = (df.repartition(3 * n_q * n_r, "_qb", "_rb") for df in (left, right))
    return left.groupBy("_qb", "_rb").cogroup(right.groupBy("_qb", "_rb")).applyInPandas(meet, schema)


def nearest(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    label_col: str,
    metric: str = "euclidean",
    skip_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
    apart: str | None = None,
) -> DataFrame:
    """The k nearest references of each query: (id, ref_id, label, distance, rank); ties by id.

    ``apart`` names a column of few values (a fold, say) of both tables: references of the query's own value take no part. Ids of queries are unique. Vectors that are null, or hold a null or a number that is not finite, take no part. Up to
    ``cell_rows`` references every query meets all; more are indexed in cells of about so many (at once, when called).
    """
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((queries, id_col), (refs, label_col))}
    group = [] if apart is None else [col_of(apart).alias("apart")]
    q = queries.select(col_of(id_col).alias("id"), _vector(queries, vec_col).alias("vec"), *group)
    r = refs.select(
        col_of(id_col).alias("id"), _vector(refs, vec_col).alias("vec"), col_of(label_col).alias("label"), *group
    )

    q, r = q.where(_usable(F.col("vec"))), r.where(_usable(F.col("vec")))
    n = r.count()
    if n > cell_rows:
        return MetricIndex(r, n, metric, cell_rows).nearest(q, k, skip_self)
    names = ["id", "ref_id", "label", "distance"]

    def best(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(qs, rs, k, metric, skip_self)[names]

    schema = f"id {kinds[id_col]}, ref_id {kinds[id_col]}, label {kinds[label_col]}, distance double"
    near = block_pairs(q, r, best, schema, block_rows)
    order = Window.partitionBy("id").orderBy("distance", "ref_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_vote(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    label_col: str,
    weights: str = "distance",
    metric: str = "euclidean",
    skip_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(id, prediction, probability): the label with the largest vote of the k nearest references.

    With ``weights='distance'`` a neighbour counts 1/distance; where some are at distance 0, only
    those count. The smallest label wins a tie.
    """
    near = nearest(queries, refs, k, id_col, vec_col, label_col, metric, skip_self, block_rows, cell_rows)
    return vote(near, weights)


def label_shares(near: DataFrame, weights: str = "distance") -> DataFrame:
    """(id, label, share): vote of each label among a query's neighbours."""
    if weights == "uniform":
        vote_of = F.lit(1.0)
    elif weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("id")) == 1
        vote_of = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
    else:
        raise ValueError(f"unknown weights {weights!r}")
    votes = near.withColumn("vote", vote_of).groupBy("id", "label").agg(F.sum("vote").alias("vote"))
    return votes.select("id", "label", (F.col("vote") / F.sum("vote").over(Window.partitionBy("id"))).alias("share"))


def vote(near: DataFrame, weights: str = "distance") -> DataFrame:
    winner = F.min_by(F.struct("label", "share"), F.struct(-F.round("share", 12), F.col("label")))
    return (
        label_shares(near, weights)
        .groupBy("id")
        .agg(winner.alias("w"))
        .select("id", F.col("w.label").alias("prediction"), F.col("w.share").alias("probability"))
    )


def cluster_distances(
    rows: DataFrame, id_col: str, vec_col: str, cluster_col: str, block_rows: int | None = None
) -> DataFrame:
    """(id, cluster, total): sum of Euclidean distances from each row to the rows of each cluster."""
    id_kind, kind = (rows.schema[c].dataType.simpleString() for c in (id_col, cluster_col))
    q = rows.select(col_of(id_col).alias("id"), _vector(rows, vec_col).alias("vec"))
    r = rows.select(
        col_of(id_col).alias("id"), _vector(rows, vec_col).alias("vec"), col_of(cluster_col).alias("cluster")
    )

    def sums(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
        names, inverse = np.unique(rs["cluster"].to_numpy(), return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        q_ids, r_ids = id_codes(qs["id"], rs["id"])
        a, b, inverse, r_ids = matrix(qs["vec"]), matrix(rs["vec"])[order], inverse[order], r_ids[order]
        totals = np.zeros((len(a), len(names)))
        # Tile by tile, so that the distances held are few; a tile's rows stand by cluster.
        for s in range(0, len(a), TILE[0]):
            for t in range(0, len(b), TILE[1]):
                d, _ = rough_distances(a[s : s + TILE[0]], b[t : t + TILE[1]], "euclidean")
                d[q_ids[s : s + TILE[0], None] == r_ids[None, t : t + TILE[1]]] = 0.0
                found, at = np.unique(inverse[t : t + TILE[1]], return_index=True)
                totals[s : s + TILE[0], found] += np.add.reduceat(d, at, axis=1)
        return pd.DataFrame(
            {
                "id": np.repeat(qs["id"].to_numpy(), len(names)),
                "cluster": np.tile(names, len(qs)),
                "total": totals.ravel(),
            }
        )

    parts = block_pairs(q, r, sums, f"id {id_kind}, cluster {kind}, total double", block_rows)
    return parts.groupBy("id", "cluster").agg(F.sum("total").alias("total"))
