"""Exact nearest neighbours through a tree of boxes, or block against block where no box can be left out.

**Index.** A tree of cuts, one column each at the median of a bounded sample, deals the reference rows to cells of about equal
size. A cell (block) knows the least and largest number of its rows in each column; the table of cells is bounded
(:data:`CELLS`).

**Search.** No row of a cell is nearer to a query than the cell's box. A query first visits its own cell, which
gives a k-th distance (cells with fewer than k rows are joined by the next nearest ones); then some more cells within that
distance, which makes it smaller; then all the rest that are still within it. The result is exact for any data. Where the data
have structure, or few columns, a query meets few cells, whatever the size of the table.

**Without structure** (random directions in many dimensions) nearly all cells stay within the distance, as for every exact
search. When the visits would move more rows than a grid of all pairs does, the last round is such a grid: both sides in a
few large parts, every part against every other in a task of its own, with the distances known so far to keep the
results small. Work is then all pairs, memory is bounded by :data:`PART_NUMBERS`, and the rows moved follow the table.

**Skew.** A cell with many rows, or many visiting queries, is dealt by hash to several tasks of bounded size. Of equal vectors only
the first that can be among k are looked at. Rows move only as they are needed: a query is written once per round with the list of
its blocks, and each round's best rows are merged into at most k per query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.operators.stages import written
from chartmill.workers import ship

#: Most cells, and rows drawn for each of them to find the cuts.
CELLS, DRAWN = 4_096, 16
#: Rows of a block aimed for, and most rows and queries that meet in a task at once.
CELL_ROWS, PART_ROWS = 2_048, 4_096
#: So many times the usual gap between neighbouring numbers is a gap to cut at.
STANDS_OUT = 4
#: Blocks that a query visits at most in the second round.
SECOND = 8
#: Queries whose bounds to all blocks are held together.
TOGETHER = 256
#: Parts of either side of a grid of all pairs at least, and numbers that a part's vectors hold at most.
GRID, PART_NUMBERS = 8, 8_388_608
#: Queries and references whose distances are held together.
TILE = (256, 4_096)
#: Pairs whose exact distances are taken together.
PAIRS = 65_536
#: Rows of a task that places rows or lists visits, aimed for.
WALKED = 32_768
#: Largest total of a rough Manhattan distance in short whole numbers; the next one marks pairs that are left out.
SHORT = 32_766


def rough_distances(a: np.ndarray, b: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Distances of all pairs, and a bound per row on how far off they may be."""
    if metric == "manhattan":
        total = np.zeros((len(a), len(b)))
        for d in range(a.shape[1]):
            total += np.abs(a[:, d, None] - b[None, :, d])
        return total, 1e-12 * (1.0 + total.max(axis=1, initial=0.0))
    if metric != "euclidean":
        raise ValueError(f"unknown metric {metric!r}")
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    slack = np.sqrt(1e-12 * (square.max(axis=1, initial=0.0) + 1.0))
    return np.sqrt(np.maximum(square - 2.0 * (a @ b.T), 0.0)), slack


def exact_distance(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    gap = a - b
    return np.abs(gap).sum(axis=1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))


def matrix(vectors: Iterable) -> np.ndarray:
    """Rows of numbers from vectors of one length; an Arrow column is not taken apart row by row."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if isinstance(vectors, pa.Array):
        return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)
    return np.stack([np.asarray(v, dtype=float) for v in vectors])


def id_codes(*ids: pd.Series) -> list[np.ndarray]:
    """Whole numbers in the order of the ids, equal for equal ids; those of nulls come last and belong to one side each."""
    together = pd.concat(ids, ignore_index=True)
    codes, found = pd.factorize(together, sort=True)
    out, at = [], 0
    for side, part in enumerate(ids):
        own = codes[at : at + len(part)].astype(np.int64)
        own[own < 0] = len(found) + side
        out.append(own)
        at += len(part)
    return out


def _few_of_equal(b: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows by id, without those that k others of the same vector always come before, whichever one id is left out."""
    order = np.argsort(ids, kind="stable")
    if len(b) <= k:
        return order
    lines = np.ascontiguousarray(b[order] + 0.0).view(np.dtype((np.void, b.shape[1] * 8))).ravel() if b.shape[1] else np.zeros(len(b))
    same, counts = np.unique(lines, return_inverse=True, return_counts=True)[1:]
    if counts.max() <= k:
        return order
    table = pd.DataFrame({"same": same.ravel(), "id": ids[order]})
    nth = table.groupby("same")["id"].rank(method="dense").to_numpy()
    copy = table.groupby(["same", "id"]).cumcount().to_numpy()
    return order[(nth <= k + 1) & (copy < k)]


def _places(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what holds, of which there is little: looked for in one line, which is several times faster."""
    return np.divmod(np.flatnonzero(near), near.shape[1])


class _Rough:
    """Tells the pairs of a tile that may be within a limit."""

    def __init__(self, b: np.ndarray, metric: str):
        if metric not in ("euclidean", "manhattan"):
            raise ValueError(f"unknown metric {metric!r}")
        self.b, self.metric, self.short = b, metric, False
        if metric == "euclidean":
            self.square = (b * b).sum(axis=1)
            self.lifted = np.column_stack([b, -0.5 * self.square])
        elif b.size:
            self.least = b.min(axis=0)
            with np.errstate(over="ignore"):
                self.span = float((b.max(axis=0) - self.least).max())
            self.steps = SHORT // b.shape[1]
            # Of too many columns or too wide numbers, whole numbers would tell little.
            self.short = self.steps >= 16 and 1e-290 < self.span < 1e290
            if self.short:
                self.step = self.span / self.steps
                self.whole, off = self._shortened(b)
                self.off = off.max()

    def _shortened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns as whole numbers of steps, and per row how far the steps are off in total.

        Numbers beyond those of b are taken at the border, which is nearer to each of b.
        """
        place = np.clip(x - self.least, 0.0, self.span)
        whole = np.rint(place / self.step)
        return np.ascontiguousarray(whole.T.astype(np.int16)), np.abs(place - whole * self.step).sum(axis=1)

    def within(self, a: np.ndarray, s: slice, limit: np.ndarray, apart: np.ndarray | None, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of a, row of the slice of b); where no limit is known, those as near as ``at`` of the tile."""
        unknown = np.isinf(limit)
        if self.short:
            return self._within_steps(a, s, limit, unknown, apart, at)
        if self.metric == "euclidean" and not unknown.any():
            # |a - b|^2 <= limit^2, with all that depends on one row alone on one side: a product and a comparison.
            own = (a * a).sum(axis=1)
            slack = np.sqrt(1e-12 * (own + self.square[s].max(initial=0.0) + 1.0))
            far = 0.5 * (own - (limit + 2 * slack) ** 2)
            near = np.column_stack([a, np.ones(len(a))]) @ self.lifted[s].T >= far[:, None]
            if apart is not None:
                near &= ~apart
            return _places(near)
        rough, slack = rough_distances(a, self.b[s], self.metric)
        if apart is not None:
            rough[apart] = np.inf
        limit = limit + 2 * slack
        if unknown.any():
            place = min(at, rough.shape[1]) - 1
            limit[unknown] = np.partition(rough[unknown], place, axis=1)[:, place] + 2 * slack[unknown]
        near = rough <= limit[:, None]
        if unknown.any() or apart is not None:
            near &= np.isfinite(rough)
        return _places(near)

    def _within_steps(self, a: np.ndarray, s: slice, limit: np.ndarray, unknown: np.ndarray, apart: np.ndarray | None, at: int) -> tuple[np.ndarray, np.ndarray]:
        """The same by Manhattan distances in whole numbers of steps."""
        left, off = self._shortened(a)
        right, rows = self.whole[:, s], self.b[s]
        total = np.zeros((len(a), len(rows)), np.int16)
        gap = np.empty((64, len(rows)), np.int16)
        for i in range(0, len(a), 64):
            part = total[i : i + 64]
            some = gap[: len(part)]
            for d in range(a.shape[1]):
                np.subtract(left[d, i : i + 64, None], right[d, None], out=some)
                np.abs(some, out=some)
                part += some
        if apart is not None:
            total[apart] = SHORT + 1
        if unknown.any():
            limit = limit.copy()
            at = min(at, len(rows))
            for i in np.flatnonzero(unknown):
                some = np.argpartition(total[i], at - 1)[:at]
                if total[i, some].max() <= SHORT:
                    limit[i] = exact_distance(a[[i]], rows[some], self.metric).max()
        slack = off + self.off + 1e-12 * (a.shape[1] * self.span + np.where(np.isinf(limit), 0.0, limit))
        most = np.minimum(np.floor((limit + slack) / self.step), SHORT).astype(np.int16)
        return _places(total <= most[:, None])


def nearest_rows(
    a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int, metric: str, skip_self: bool, limit: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance): the k nearest rows of b to each row of a, within its limit; ties to the smaller id."""
    kept = _few_of_equal(b, b_ids, k)
    b, ids = b[kept], b_ids[kept]
    rough = _Rough(b, metric)
    out: list[tuple[np.ndarray, ...]] = []
    for s in range(0, len(a), TILE[0]):
        q, q_ids = a[s : s + TILE[0]], a_ids[s : s + TILE[0]]
        within = np.full(len(q), np.inf) if limit is None else limit[s : s + TILE[0]].astype(float)
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for t in range(0, len(b), TILE[1]):
            tile = slice(t, t + TILE[1])
            apart = q_ids[:, None] == ids[None, tile] if skip_self else None
            i, j = rough.within(q, tile, within, apart, k)
            if not len(i):
                continue
            j = j + t
            d = np.concatenate([exact_distance(q[i[p : p + PAIRS]], b[j[p : p + PAIRS]], metric) for p in range(0, len(i), PAIRS)])
            fits = d <= within[i]
            i, j, d = (np.concatenate([x, y[fits]]) for x, y in zip(best, (i, j, d)))
            # Rows of b stand by id, so the place tells ties.
            order = np.lexsort((j, d, i))
            i, j, d = i[order], j[order], d[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            full = place == k - 1
            within[i[full]] = np.minimum(within[i[full]], d[full])
            best = tuple(x[place < k] for x in (i, j, d))
        out.append((best[0] + s, kept[best[1]], best[2]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest_apart(
    a: np.ndarray, a_ids: np.ndarray, b: np.ndarray, b_ids: np.ndarray, k: int, metric: str, skip_self: bool, limit: np.ndarray | None,
    groups: Sequence[np.ndarray] | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same among the rows of b that are of another of the ``groups`` (few, of a and of b) than the row of a."""
    if groups is None:
        return nearest_rows(a, a_ids, b, b_ids, k, metric, skip_self, limit)
    out = []
    for group in np.unique(groups[0]):
        here, there = np.flatnonzero(groups[0] == group), np.flatnonzero(groups[1] != group)
        i, j, d = nearest_rows(a[here], a_ids[here], b[there], b_ids[there], k, metric, skip_self, None if limit is None else limit[here])
        out.append((here[i], there[j], d))
    return tuple(np.concatenate(x) for x in zip(*out))


def best_in_block(qs: pd.DataFrame, rs: pd.DataFrame, k: int, metric: str, skip_self: bool) -> pd.DataFrame:
    """The k nearest rows of ``rs`` (id, vec, label) to each row of ``qs`` (id, vec, and ``limit`` where one is known).

    With a column ``apart`` rows of the same value in it do not meet.
    """
    a_ids, b_ids = id_codes(qs["id"], rs["id"])
    limit = qs["limit"].to_numpy() if "limit" in qs else None
    groups = id_codes(qs["apart"], rs["apart"]) if "apart" in qs else None
    i, j, d = nearest_apart(matrix(qs["vec"]), a_ids, matrix(rs["vec"]), b_ids, k, metric, skip_self, limit, groups)
    return pd.DataFrame(
        {"at": i, "id": qs["id"].to_numpy()[i], "ref_id": rs["id"].to_numpy()[j], "label": rs["label"].to_numpy()[j], "distance": d}
    )


@dataclass(frozen=True)
class Cuts:
    """A tree of cuts: a row goes left where its column is less than the cut; ``cell`` is a leaf's number, else -1."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cell: np.ndarray

    def cells(self, rows: np.ndarray) -> np.ndarray:
        at, line = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while True:
            inner = self.cell[at] < 0
            if not inner.any():
                return self.cell[at]
            left = rows[line, self.column[at]] < self.cut[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def _middle(x: np.ndarray) -> float:
    """The median of sorted numbers that are not all equal; where a gap of the middle half stands out, the number after the one next to it.

    A cut through a dense group sends its queries to both sides.
    """
    low, high = len(x) // 4, max(len(x) // 4 + 1, len(x) - len(x) // 4)
    gaps = np.diff(x[low:high])
    if len(gaps) and gaps.max() > STANDS_OUT * (x[high - 1] - x[low]) / len(gaps):
        widest = np.flatnonzero(gaps == gaps.max())
        return float(x[low + 1 + widest[np.argmin(np.abs(low + 1 + widest - len(x) // 2))]])
    middle = float(x[len(x) // 2])
    return middle if middle > x[0] else float(x[x > middle][0])


def cuts_of(sample: np.ndarray, many: int) -> Cuts:
    """A tree of at most ``many`` cells: the one with most rows of the sample is cut next, in the middle of its widest column."""
    column, cut, left, right = [0], [0.0], [0], [0]
    heap = [(-len(sample), 0)]
    rows, leaves = {0: sample}, {0}
    while heap and len(leaves) < many:
        at = heapq.heappop(heap)[1]
        here = rows.pop(at)
        widest = int(np.argmax(here.max(axis=0) - here.min(axis=0))) if here.size else 0
        x = here[:, widest] if here.size else np.empty(0)
        if not len(x) or x.min() == x.max():
            continue
        middle = _middle(np.sort(x))
        column[at], cut[at], left[at], right[at] = widest, middle, len(cut), len(cut) + 1
        leaves.discard(at)
        for part in (here[x < middle], here[x >= middle]):
            leaves.add(len(cut))
            rows[len(cut)] = part
            heapq.heappush(heap, (-len(part), len(cut)))
            column.append(0), cut.append(0.0), left.append(0), right.append(0)
    cell = np.full(len(cut), -1, np.int64)
    cell[sorted(leaves)] = np.arange(len(leaves))
    return Cuts(np.array(column), np.array(cut), np.array(left), np.array(right), cell)


@dataclass(frozen=True)
class Blocks:
    """The index's table: the tree of cuts, and for each block its number (ascending), box and rows."""

    cuts: Cuts
    number: np.ndarray
    least: np.ndarray
    largest: np.ndarray
    rows: np.ndarray
    metric: str

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No row of the block (column) is nearer to the query (row) than this."""
        total = np.zeros((len(queries), len(self.number)))
        for d in range(queries.shape[1]):
            x = queries[:, d, None]
            gap = np.maximum(self.least[None, :, d] - x, x - self.largest[None, :, d])
            np.maximum(gap, 0.0, out=gap)
            total += gap if self.metric == "manhattan" else gap * gap
        return (total if self.metric == "manhattan" else np.sqrt(total)) * (1.0 - 1e-9)

    def first(self, queries: np.ndarray, k: int) -> list[list[int]]:
        """Each query's own block; where it has fewer than k rows, the blocks with the smallest bounds until they hold k."""
        own = self.cuts.cells(queries)
        place = np.minimum(np.searchsorted(self.number, own), len(self.number) - 1)
        enough = (self.number[place] == own) & (self.rows[place] >= k)
        visits = [[int(c)] for c in own]
        for i, bound in zip(np.flatnonzero(~enough), self.bounds(queries[~enough])):
            order = np.argsort(bound, kind="stable")
            visits[i] = self.number[order[: int(np.searchsorted(np.cumsum(self.rows[order]), k)) + 1]].tolist()
        return visits

    def further(self, bound: np.ndarray, limit: float, seen: list[int], most: int | None) -> list[int]:
        """Blocks within the limit that have not been visited, nearest first."""
        left = bound <= limit
        left[np.searchsorted(self.number, seen)] = False
        at = np.flatnonzero(left)
        if most is not None and len(at) > most:
            at = at[np.argsort(bound[at], kind="stable")][:most]
        return self.number[at].tolist()


class MetricIndex:
    """Rows (``id``, ``vec``, ``label``) in blocks; see the module's text.

    With a column ``apart`` of few values, which the queries have too, a query meets the rows of other values alone.
    """

    def __init__(self, refs: DataFrame, n: int, metric: str, cell_rows: int = CELL_ROWS):
        ship(refs.sparkSession)
        self.metric, self.n = metric, n
        self.apart = ["apart"] if "apart" in refs.columns else []
        many = max(1, min(CELLS, math.ceil(n / cell_rows)))
        drawn = refs.select("vec").orderBy(F.xxhash64("id"), "vec").limit(many * DRAWN).toArrow()
        cuts = cuts_of(matrix(drawn.column(0)), many)

        def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    cell = pa.array(cuts.cells(matrix(b.column("vec"))), pa.int32())
                    yield pa.RecordBatch.from_arrays([*b.columns, cell], schema=_arrow(b, "block"))

        fields = [*refs.schema.fields, T.StructField("block", T.IntegerType())]
        self.rows = written(_dealt(refs, n).mapInArrow(place, T.StructType(fields)))
        found = self._boxes()
        number = np.array(sorted(found))
        self.blocks = Blocks(cuts, number, *(np.array([found[b][i] for b in number]) for i in range(3)), metric)
        #: Distances that the last search measured (rows of all visited blocks).
        self.compared = 0
        #: Whether its last round was the grid of all pairs.
        self.gridded = False

    def _boxes(self) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
        """Least and largest numbers and rows of each block; every task hands on one box per block."""

        def box(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for b in batches:
                if not len(b):
                    continue
                x, block = matrix(b.column("vec")), b.column("block").to_numpy()
                order = np.argsort(block, kind="stable")
                numbers, at, counts = np.unique(block[order], return_index=True, return_counts=True)
                least, largest = np.minimum.reduceat(x[order], at), np.maximum.reduceat(x[order], at)
                for c, lo, hi, m in zip(numbers.tolist(), least, largest, counts.tolist()):
                    old = held.get(c)
                    held[c] = [lo, hi, m] if old is None else [np.minimum(lo, old[0]), np.maximum(hi, old[1]), m + old[2]]
            lists = [pa.array([h[i] for h in held.values()], pa.list_(pa.float64())) for i in (0, 1)]
            numbers = pa.array(list(held), pa.int32()), pa.array([h[2] for h in held.values()], pa.int64())
            yield pa.RecordBatch.from_arrays([numbers[0], *lists, numbers[1]], names=["block", "least", "largest", "n"])

        def merge(t: pa.Table) -> pa.Table:
            least, largest = matrix(t.column("least")).min(axis=0), matrix(t.column("largest")).max(axis=0)
            n = sum(t.column("n").to_pylist())
            return pa.table({"block": t.column("block")[:1], "least": [least.tolist()], "largest": [largest.tolist()], "n": [n]}, schema=t.schema)

        schema = "block int, least array<double>, largest array<double>, n bigint"
        parts = self.rows.select("block", "vec").mapInArrow(box, schema).groupBy("block").applyInArrow(merge, schema)
        return {r["block"]: (np.array(r["least"]), np.array(r["largest"]), r["n"]) for r in parts.collect()}

    def nearest(self, queries: DataFrame, k: int, skip_self: bool = False) -> DataFrame:
        """(id, ref_id, label, distance, rank) of each query (id, vec); ties by id."""
        kinds = {c: self.rows.schema[c].dataType.simpleString() for c in ("id", "label")}
        best = f"array<struct<distance:double,ref_id:{kinds['id']},label:{kinds['label']}>>"
        asking = queries.count()
        state = _dealt(queries, asking).select(
            F.monotonically_increasing_id().alias("q"), "id", "vec", *self.apart, F.expr(f"CAST(array() AS {best})").alias("best"), F.expr("CAST(array() AS array<int>)").alias("seen")
        )
        self.compared, self.gridded = 0, False
        blocks = self.blocks
        wanted = k + int(skip_self)
        rows_of = dict(zip(blocks.number.tolist(), blocks.rows.tolist()))
        # Every round widens the visits; the last takes all that is left, so it ends the search.
        for number, most in enumerate((0, SECOND, None)):
            limit = F.when(F.size("best") >= k, F.element_at("best", -1)["distance"]).otherwise(F.lit(float("inf")))

            def walk(batches: Iterable[pa.RecordBatch], number=number, most=most) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    if not len(b):
                        continue
                    vectors, limits, seen = matrix(b.column("vec")), b.column("limit").to_numpy(), b.column("seen").to_pylist()
                    visits: list[list[int]] = []
                    for s in range(0, len(b), TOGETHER):
                        some = vectors[s : s + TOGETHER]
                        if number == 0:
                            visits += blocks.first(some, wanted)
                        else:
                            visits += [blocks.further(bound, limits[i], seen[i], most) for i, bound in enumerate(blocks.bounds(some), s)]
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(visits, pa.list_(pa.int32()))], schema=_arrow(b, "visits"))

            asked = state.withColumn("limit", limit)
            schema = T.StructType([*asked.schema.fields, T.StructField("visits", T.ArrayType(T.IntegerType()))])
            # Before the first round the row number must be fixed, so each round is written.
            walked = written(asked.mapInArrow(walk, schema))
            coming = {r["v"]: r["count"] for r in walked.select(F.explode("visits").alias("v")).groupBy("v").count().collect()}
            if not coming:
                state = walked.drop("visits", "limit")
                break
            if number == 2:
                grid = self._grid(asking)
                moved = sum(times + rows_of[v] * math.ceil(times / PART_ROWS) for v, times in coming.items())
                if moved > asking * grid[1] + self.n * grid[0]:
                    self.compared += asking * self.n
                    self.gridded = True
                    state = walked.join(self._all_pairs(walked, grid, k, skip_self, kinds), "q").select("id", F.col("new").alias("best"))
                    break
            self.compared += sum(times * rows_of[v] for v, times in coming.items())
            found = self._meet(walked, coming, k, skip_self, kinds)
            merged = F.slice(F.array_sort(F.concat("best", F.coalesce("new", F.expr(f"CAST(array() AS {best})")))), 1, k)
            state = walked.join(found, "q", "left").select(
                "q", "id", "vec", *self.apart, merged.alias("best"), F.concat("seen", "visits").alias("seen")
            )
        ranked = state.select("id", F.posexplode("best").alias("rank", "b"))
        return ranked.select("id", "b.ref_id", "b.label", "b.distance", (F.col("rank") + 1).alias("rank"))

    def _grid(self, queries: int) -> tuple[int, int]:
        """Parts of the queries and of the references for a grid of all pairs."""
        return tuple(grid_parts(n, self.blocks.least.shape[1]) for n in (queries, self.n))

    def _meet(self, walked: DataFrame, coming: dict[int, int], k: int, skip_self: bool, kinds: dict[str, str]) -> DataFrame:
        """(q, new): each visiting query's best rows of the blocks it visits."""
        # One row per visited block, with the number of parts of its rows and of its queries.
        parts = [
            (int(number), max(1, math.ceil(int(n) / PART_ROWS)), math.ceil(coming[int(number)] / PART_ROWS))
            for number, n in zip(self.blocks.number, self.blocks.rows)
            if int(number) in coming
        ]
        table = F.broadcast(walked.sparkSession.createDataFrame(parts, "block int, r_parts int, q_parts int"))
        r_parts, q_parts = F.col("r_parts"), F.col("q_parts")
        left = walked.withColumn("block", F.explode("visits")).join(table, "block").select(
            "block", hashed_part(q_parts, "q").alias("qp"), spread(r_parts).alias("rp"), "q", "id", "vec", "limit", *self.apart
        )
        right = self.rows.join(table, "block").select(
            "block", spread(q_parts).alias("qp"), hashed_part(r_parts, "id", "vec").alias("rp"), "id", "vec", "label", *self.apart
        )
        keys = ["block", "qp", "rp"]
        return self._best(left.groupBy(*keys), right.groupBy(*keys), k, skip_self, kinds)

    def _all_pairs(self, walked: DataFrame, grid: tuple[int, int], k: int, skip_self: bool, kinds: dict[str, str]) -> DataFrame:
        """(q, new): each query's best rows of all, within its limit; every part of the queries meets every part of the rows."""
        tasks = 3 * grid[0] * grid[1]
        q_parts, r_parts = F.lit(grid[0]), F.lit(grid[1])
        left = walked.select(hashed_part(q_parts, "q").alias("qp"), spread(r_parts).alias("rp"), "q", "id", "vec", "limit", *self.apart)
        right = self.rows.select(spread(q_parts).alias("qp"), hashed_part(r_parts, "id", "vec").alias("rp"), "id", "vec", "label", *self.apart)
        keys = ["qp", "rp"]
        # Few rows with much work: a number of partitions that is given is not merged by size.
        return self._best(left.repartition(tasks, *keys).groupBy(*keys), right.repartition(tasks, *keys).groupBy(*keys), k, skip_self, kinds)

    def _best(self, left, right, k: int, skip_self: bool, kinds: dict[str, str]) -> DataFrame:
        """(q, new): the k best rows per query over all groups of queries and rows that meet."""
        metric, apart = self.metric, bool(self.apart)

        def meet(qs: pa.Table, rs: pa.Table) -> pa.Table:
            i = j = np.empty(0, np.int64)
            d = np.empty(0)
            if len(qs) and len(rs):
                a_ids, b_ids = id_codes(qs.column("id").to_pandas(), rs.column("id").to_pandas())
                limit = qs.column("limit").to_numpy()
                groups = id_codes(qs.column("apart").to_pandas(), rs.column("apart").to_pandas()) if apart else None
                i, j, d = nearest_apart(matrix(qs.column("vec")), a_ids, matrix(rs.column("vec")), b_ids, k, metric, skip_self, limit, groups)
            columns = [qs.column("q").take(pa.array(i)), pa.chunked_array([pa.array(d)]), *(rs.column(c).take(pa.array(j)) for c in ("id", "label"))]
            return pa.Table.from_arrays(columns, names=["q", "distance", "ref_id", "label"])

        schema = f"q long, distance double, ref_id {kinds['id']}, label {kinds['label']}"
        met = left.cogroup(right).applyInArrow(meet, schema)
        # Only k rows per query and task are shuffled, and k of them kept.
        line = Window.partitionBy("q").orderBy("distance", "ref_id")
        few = met.withColumn("place", F.row_number().over(line)).where(F.col("place") <= k)
        return few.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("distance", "ref_id", "label"))).alias("new"))


def grid_parts(n: int, dims: int) -> int:
    """Parts of n rows for a grid of all pairs: a fixed number, more only where a part would not fit in memory."""
    return max(1, min(GRID, math.ceil(n / CELL_ROWS)), math.ceil(n * max(1, dims) / PART_NUMBERS))


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """The rows over enough tasks for work that each of them causes: a small file comes in few."""
    return rows.repartition(max(1, min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / CELL_ROWS)), math.ceil(n / WALKED)))


def spread(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def hashed_part(n: Column, *of: str) -> Column:
    return F.pmod(F.xxhash64(*of), n).cast("int")


def _arrow(batch: pa.RecordBatch, *added: str) -> pa.Schema:
    kinds = {"block": pa.int32(), "visits": pa.list_(pa.int32())}
    return pa.schema([*batch.schema, *[pa.field(a, kinds[a]) for a in added]])
