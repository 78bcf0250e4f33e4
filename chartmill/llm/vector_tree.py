"""Approximate nearest neighbours by largest inner product: a hierarchical k-means tree, searched best bin first.

**Tree.** Vectors get one more component, the root of (largest squared length - own squared length), so that the
largest inner product is the smallest distance. A tree of k-means splits is fitted on a bounded sample and then
assigns **every** row to a leaf.

**Search.** A query walks the tree with a priority queue by distance to node centres and visits leaves in the order
in which they leave it. How many is calibrated: for some queries the true neighbours are found among all rows, in
blocks, and visits are widened until the neighbours' leaves are reached for the recall asked for. Each query then
meets the rows of its leaves. Leaves that are neighbours in the tree and have few rows share a bucket, so that a query
is sent once for several and hands back its best of them all; a bucket with many rows or many visiting queries is cut
into cells of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.llm.common import saved, ship

#: Rows the tree is fitted on, at most (in expectation of a random sample), and leaves aimed for, at most; tables of n
#: rows aim for the root of n.
SAMPLE = 32_768
LEAVES = 2_048
BRANCHES = 8
#: Queries that calibrate the number of leaves visited.
CALIBRATION = 200
CELL_ROWS, CELL_QUERIES = 4_096, 2_048


class KMeansTree:
    """Nodes with centres; a node's children are consecutive. Leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.centres = [sample.mean(axis=0)] if len(sample) else [np.zeros(sample.shape[1])]
        self.first, self.size = [0], [0]
        todo = [(0, sample)]
        small = max(1, math.ceil(len(sample) / max(leaves, 1)))
        while todo:
            node, rows = todo.pop()
            if len(rows) <= small:
                continue
            centres = self._split(rows, min(branches, math.ceil(len(rows) / small)), rng)
            own = _nearest(rows, centres)
            used = np.unique(own)
            if len(used) < 2:
                continue
            self.first[node], self.size[node] = len(self.centres), len(used)
            for c in used:
                todo.append((len(self.centres), rows[own == c]))
                self.centres.append(centres[c])
                self.first.append(0)
                self.size.append(0)
        self.centres = np.array(self.centres)
        self.leaf = np.cumsum(np.array(self.size) == 0) - 1
        self.leaves = int(self.leaf[-1]) + 1

    @staticmethod
    def _split(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
        centres = rows[rng.choice(len(rows), k, replace=False)]
        for _ in range(rounds):
            own = _nearest(rows, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, rows)
            n = np.bincount(own, minlength=k)
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        return centres

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: down the tree by the nearest centre."""
        node = np.zeros(len(rows), np.int64)
        size, first = np.array(self.size), np.array(self.first)
        while True:
            inner = np.unique(node[size[node] > 0])
            if not len(inner):
                return self.leaf[node]
            for v in inner:
                at = np.flatnonzero(node == v)
                node[at] = first[v] + _nearest(rows[at], self.centres[first[v] : first[v] + size[v]])

    def visits(self, query: np.ndarray, most: int, rows_in: np.ndarray, least_rows: int) -> list[int]:
        """Leaves best bin first: ``most`` of them, and more until they hold ``least_rows`` rows."""
        gap = self.centres - query
        distance = (gap * gap).sum(axis=1)
        queue, found, rows = [(0.0, 0)], [], 0
        while queue and (len(found) < most or rows < least_rows):
            _, v = heapq.heappop(queue)
            if self.size[v] == 0:
                found.append(int(self.leaf[v]))
                rows += int(rows_in[self.leaf[v]])
            for c in range(self.first[v], self.first[v] + self.size[v]):
                heapq.heappush(queue, (float(distance[c]), c))
        return found


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def _augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0.0))
    return np.column_stack([vectors, rest])


def _best(ids: np.ndarray, q: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query index, row index, score) of each query's k best rows by (score, smaller id), its own id left out.

    A matrix product finds candidates with a margin; scores are sums over one pair, the same wherever it stands.
    """
    out = []
    size = float(np.abs(rows).sum(axis=1).max() * np.abs(q).max()) if len(rows) and len(q) else 0.0
    for s in range(0, len(q), 64):
        rough = q[s : s + 64] @ rows.T
        rough[ids[s : s + 64, None] == row_ids[None, :]] = -np.inf
        at = min(k, rough.shape[1])
        limit = np.partition(rough, rough.shape[1] - at, axis=1)[:, rough.shape[1] - at]
        i, j = np.nonzero((rough >= limit[:, None] - 1e-12 * size) & (rough > -np.inf))
        score = (q[s + i] * rows[j]).sum(axis=1)
        order = np.lexsort((row_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        out.append((s + i[keep], j[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 3


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec as doubles): rows with an id and a vector of the usual length that is finite, full and not zero."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    off = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & vec.isNotNull() & ~off & F.exists(vec, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vec") == (usual["n"] if usual else 0))


def _top(found: DataFrame, k: int) -> DataFrame:
    line = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)


def nearest_by_tree(
    df: DataFrame,
    query_where: Column,
    k: int = 20,
    recall: float = 0.95,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    sample: int = SAMPLE,
    leaves: int = LEAVES,
    calibration: int = CALIBRATION,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's k nearest found, by inner product.

    Queries are the rows where ``query_where`` (on columns ``id`` and ``vec``) holds; candidates are all rows with
    another id. Ties go to the smaller id. Vectors that are null, zero, of another length than most, or hold a null
    or a number that is not finite take no part, nor do rows without id. Rows repeated with one id are candidates
    each; as a query, an id counts once (with the vector of smallest hash). Fewer than k candidates are all
    returned. No valid row or no query: no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    ship(spark)
    schema = "query_id long, vec_id long, score double"
    rows = saved(_valid(df, id_col, vec_col))
    longest = F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    n, top = rows.agg(F.count("*"), longest).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = saved(rows.where(query_where).groupBy("id").agg(F.min_by("vec", F.xxhash64("vec")).alias("vec")))

    # A random sample in a stable order: the same tree each time.
    taken = rows.sample(fraction=min(1.0, sample / n), seed=11).orderBy("id").toPandas()
    points = np.stack(taken["vec"].to_numpy()) if len(taken) else np.zeros((0, len(rows.first()["vec"])))
    tree = KMeansTree(_augmented(points, top), min(leaves, max(1, math.isqrt(n))))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                leaf = tree.assign(_augmented(_matrix(b.column(1)), top))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], names=["id", "vec", "leaf"])

    index = saved(rows.mapInArrow(place, "id long, vec array<double>, leaf int"))
    counted = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    rows_in = np.array([counted.get(i, 0) for i in range(tree.leaves)])
    # Rows that may share the query's id and so be no candidates.
    own = index.groupBy("id").count().agg(F.max("count")).first()[0]
    visited = _calibrated(tree, index, queries, top, rows_in, k, recall, calibration)

    bucket_of = buckets(rows_in)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, bucket, leaf_lists = [], [], []
            for i, q in enumerate(_augmented(_matrix(b.column(1)), 0.0) if len(b) else ()):
                found: dict[int, list[int]] = {}
                for leaf in tree.visits(q, visited, rows_in, k + own):
                    found.setdefault(int(bucket_of[leaf]), []).append(leaf)
                at += [i] * len(found)
                bucket += found
                leaf_lists += found.values()
            rows_at = pa.array(at, pa.int32())
            arrays = [b.column(0).take(rows_at), b.column(1).take(rows_at), pa.array(bucket, pa.int32())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(leaf_lists, pa.list_(pa.int32()))], names=["id", "vec", "bucket", "leaves"])

    walks = saved(queries.mapInArrow(walk, "id long, vec array<double>, bucket int, leaves array<int>"))
    coming = {r["bucket"]: r["count"] for r in walks.groupBy("bucket").count().collect()}
    held = np.bincount(bucket_of, rows_in)
    r_parts = F.array(*[F.lit(math.ceil(max(x, 1) / CELL_ROWS)) for x in held.tolist()])
    q_parts = F.array(*[F.lit(math.ceil(max(coming.get(i, 0), 1) / CELL_QUERIES)) for i in range(len(held))])
    r_of, q_of = F.get(r_parts, F.col("bucket")), F.get(q_parts, F.col("bucket"))
    hashed = F.xxhash64("id")

    def spread(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), parts - 1))

    placed = index.withColumn("bucket", F.get(F.array(*map(F.lit, bucket_of.tolist())), F.col("leaf")))
    left = walks.select("bucket", F.pmod(hashed, q_of).cast("int").alias("q"), spread(r_of).alias("r"), "id", "vec", "leaves")
    right = placed.select("bucket", F.pmod(hashed, r_of).cast("int").alias("r"), spread(q_of).alias("q"), "id", "vec", "leaf")

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if q.empty or r.empty:
            return pd.DataFrame({c: [] for c in names})
        visitors: dict[int, list[int]] = {}
        for i, own_leaves in enumerate(q["leaves"]):
            for leaf in own_leaves:
                visitors.setdefault(int(leaf), []).append(i)
        ids, vectors = q["id"].to_numpy(), np.stack(q["vec"].to_numpy())
        found = []
        for leaf, rows_of in r.groupby("leaf"):
            if leaf in visitors:
                some, row_ids = np.array(visitors[leaf]), rows_of["id"].to_numpy()
                i, j, score = _best(ids[some], vectors[some], row_ids, np.stack(rows_of["vec"].to_numpy()), k)
                found.append(pd.DataFrame(dict(zip(names, (ids[some[i]], row_ids[j], score)))))
        if not found:
            return pd.DataFrame({c: [] for c in names})
        best = pd.concat(found).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return best.groupby("query_id", sort=False).head(k)

    met = left.groupBy("bucket", "q", "r").cogroup(right.groupBy("bucket", "q", "r")).applyInPandas(meet, schema)
    return _top(met, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def buckets(rows_in: np.ndarray, most: int = CELL_ROWS) -> np.ndarray:
    """Bucket of each leaf: neighbours in the tree share one until it holds ``most`` rows."""
    of, bucket, held = [], 0, 0
    for n in rows_in.tolist():
        if held and held + n > most:
            bucket, held = bucket + 1, 0
        held += n
        of.append(bucket)
    return np.array(of)


def _calibrated(
    tree: KMeansTree, index: DataFrame, queries: DataFrame, top: float, rows_in: np.ndarray, k: int, recall: float, many: int
) -> int:
    """Leaves to visit so that the recall over some queries, measured against all rows, is as asked."""
    some = queries.orderBy(F.xxhash64("id")).limit(many).collect()
    if not some:
        return 1
    ids, q = np.array([r["id"] for r in some]), np.array([r["vec"] for r in some])

    def brute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row_ids, vectors, leaf = b.column(0).to_numpy(), _matrix(b.column(1)), b.column(2).to_numpy()
            for s in range(0, len(b), CELL_ROWS):
                part = slice(s, s + CELL_ROWS)
                i, j, score = _best(ids, q, row_ids[part], vectors[part], k)
                arrays = [pa.array(x) for x in (ids[i], row_ids[part][j], score)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(leaf[part][j], pa.int32())], names=["query_id", "vec_id", "score", "leaf"])

    true = _top(index.mapInArrow(brute, "query_id long, vec_id long, score double, leaf int"), k).select("query_id", "leaf").collect()
    place = {
        int(i): {leaf: at for at, leaf in enumerate(tree.visits(v, tree.leaves, rows_in, 0))}
        for i, v in zip(ids, _augmented(q, 0.0))
    }
    needed = np.array([place[r["query_id"]][r["leaf"]] for r in true])
    visited = 1
    while len(needed) and (needed < visited).mean() < recall:
        visited += max(1, visited // 8)
    return min(visited, tree.leaves)
