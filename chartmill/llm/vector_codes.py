"""Vector code compression: each vector becomes one byte per part, found by Orchard's search.

**Codes.** A vector's components become whole numbers ``floor(scale * x)``, cut into equal parts. Each part position has a
codebook; a part is replaced by the number of its nearest entry (squared Euclidean distance, ties to the lower number).
Codebooks start as parts of the first vectors and are moved to floored means for a number of rounds.

**Orchard's search.** For every entry the others are listed by distance from it. From a current entry s at distance d to
the point, s's list is read: an entry further than 2d from s lies further than d from the point, so the reading stops; an
entry that is nearer to the point becomes the current one, and its list is read from the start. Entries met before are
marked and not measured again. All rows of an Arrow batch take each step at once.

**At scale.** A round is one pass over the vectors: tasks hand on a count and a sum per entry, which Spark adds up; only
codebooks (parts x entries) reach the driver and go out with the tasks. Rows never move, whatever their values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from chartmill.llm.common import map_arrow, ship
from chartmill.llm.integer_vectors import as_lists, floored_means, group_sums, integers, usual_length, vector_column
from chartmill.operators.lookup import attach

#: Rows searched together.
TOGETHER = 8_192


@dataclass(frozen=True)
class Neighbours:
    """An entry's others by distance from it (ties: the lower number), and squared distances between entries."""

    order: np.ndarray
    gaps: np.ndarray
    start: int

    @classmethod
    def of(cls, entries: np.ndarray) -> Neighbours:
        gaps = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        order = np.argsort(gaps, axis=1, kind="stable")
        own = np.arange(len(entries))[:, None]
        # The entry nearest to all others begins; as float, the sum of squares cannot overflow.
        return cls(order[order != own].reshape(len(entries), -1), gaps, int(gaps.astype(float).sum(axis=1).argmin()))


def orchard(points: np.ndarray, entries: np.ndarray, lists: Neighbours) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of each point's nearest entry, its squared distance, and how many distances were measured."""
    n, k = len(points), len(entries)
    best = np.full(n, lists.start)
    distance = ((points - entries[lists.start]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[:, lists.start] = True
    at, measured = np.zeros(n, np.int64), n
    live = np.arange(n if k > 1 else 0)
    while len(live):
        other = lists.order[best[live], at[live]]
        near = lists.gaps[best[live], other] <= 4 * distance[live]
        live, other = live[near], other[near]
        at[live] += 1
        fresh = ~seen[live, other]
        row, other = live[fresh], other[fresh]
        seen[row, other] = True
        measured += len(row)
        d = ((points[row] - entries[other]) ** 2).sum(axis=1)
        better = (d < distance[row]) | ((d == distance[row]) & (other < best[row]))
        row = row[better]
        best[row], distance[row], at[row] = other[better], d[better], 0
        live = live[at[live] < k - 1]
    return best, distance, measured


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` holds whole numbers; a vector's components are ``floor(scale * x)``."""

    entries: np.ndarray
    scale: int

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def codes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part of every point, and the squared distance over all parts."""
        parts, _, width = self.entries.shape
        lists = [Neighbours.of(e) for e in self.entries]
        found = np.zeros((len(points), parts), np.int64)
        error = np.zeros(len(points), np.int64)
        for s in range(0, len(points), TOGETHER):
            some = slice(s, s + TOGETHER)
            for p in range(parts):
                found[some, p], d, _ = orchard(points[some, p * width : (p + 1) * width], self.entries[p], lists[p])
                error[some] += d
        return found, error

    def decode(self, code: bytes) -> list[float]:
        """The vector that a code stands for: the middle of each whole number's step."""
        whole = np.concatenate([self.entries[p][c] for p, c in enumerate(code)])
        return ((whole + 0.5) / self.scale).tolist()


def fit_codebooks(
    df: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> Codebooks | None:
    """Codebooks of all vectors that take part (see :func:`encode`); None if there is none.

    They start as the parts of the ``entries`` smallest ids (nulls last; of rows with one id the smallest vector), of
    fewer if there are fewer ids. An entry that no part is nearest to stays. Each round reads ``df`` again: hand in a
    written table, not a long plan.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    ship(df.sparkSession)
    vec = vector_column(df, vec_col)
    dims = usual_length(df, vec, parts)
    if not dims:
        return None
    width = dims // parts
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vec.alias("v"))

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each task's smallest ids, with their smallest vectors."""
        held: dict = {}
        for b in batches:
            at, points = integers(b.column(1), dims, scale)
            last = max(map(_place, held)) if len(held) == entries else None
            for row, i in enumerate(b.column(0).take(pa.array(at)).to_pylist()):
                if last is None or _place(i) <= last:
                    v = tuple(points[row].tolist())
                    held[i] = min(held.get(i, v), v)
            held = {i: held[i] for i in sorted(held, key=_place)[:entries]}
        ids = pa.array(list(held), rows_type)
        yield pa.RecordBatch.from_arrays([ids, as_lists(np.array(list(held.values()), np.int64).reshape(-1, dims))], names=["id", "v"])

    id_type = rows.schema["id"].dataType
    rows_type = to_arrow_type(id_type)
    schema = T.StructType([T.StructField("id", id_type), T.StructField("v", T.ArrayType(T.LongType()))])
    kept = rows.mapInArrow(smallest, schema)
    first = kept.groupBy("id").agg(F.min("v").alias("v")).orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    if not first:
        return None
    books = Codebooks(np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2), scale)
    for _ in range(rounds):
        means = floored_means(_sums(rows.select("v"), books), ["part", "entry"], width)
        moved = books.entries.copy()
        for (p, e), mean in means.items():
            moved[p, e] = mean
        if (moved == books.entries).all():
            break  # further rounds would change nothing
        books = Codebooks(moved, scale)
    return books


def _place(i) -> tuple:
    """Order of ids, null last."""
    return (i is None, 0 if i is None else i)


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, s) of each task: count and sums of the parts whose nearest entry it is."""
    parts, entries, width = books.entries.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            _, points = integers(b.column(0), books.dims, books.scale)
            found, _ = books.codes(points)
            for p in range(parts):
                times, sums = group_sums(found[:, p], points[:, p * width : (p + 1) * width], entries)
                n[p] += times
                s[p] += sums
        p, e = np.nonzero(n)
        arrays = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), as_lists(s[p, e])]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "n", "s"])

    return vectors.mapInArrow(add, "part int, entry int, n long, s array<long>")


def encode(df: DataFrame, books: Codebooks, vec_col: str = "embedding") -> DataFrame:
    """The rows of ``df`` that take part, with ``code`` (binary, one byte per part) and ``error`` (long, the squared
    distance between whole-number vector and code, over all parts); they replace columns of these names.

    Vectors that are null, hold a null or a number that is not finite take no part, nor do those of another length
    than the codebooks' (:func:`fit_codebooks` takes the commonest that parts divide), nor components so large that
    squared distances leave 64 bits (``integer_vectors.largest``). Rows with a null id, repeated rows and equal
    vectors are coded each; ties go to the lower entry. An empty table stays empty.
    """
    carry = [c for c in df.columns if c not in ("code", "error")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for b in batches:
            at, points = integers(b.column(len(carry)), books.dims, books.scale)
            found, error = books.codes(points)
            kept = b.take(pa.array(at))
            flat = found.astype(np.uint8).tobytes()
            parts = found.shape[1]
            code = pa.array([flat[i : i + parts] for i in range(0, len(flat), parts)], pa.binary())
            yield [*kept.columns[: len(carry)], code, pa.array(error)]

    return map_arrow(df, carry, [vector_column(df, vec_col)], run, {"code": T.BinaryType(), "error": T.LongType()})


def with_group_error(coded: DataFrame, group_col: str = "label", name: str = "label_error") -> DataFrame:
    """Adds the sum of ``error`` over the rows of an equal group, nulls together. Any number of groups, of any size."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("long")
    return attach(coded, group_col, coded.groupBy(F.col(f"`{group_col}`").alias("group")).agg(total.alias("total")), "group", "total", name)
