"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.workers import ship

__all__ = ["WORD", "dealt_again", "map_arrow", "named", "numbered", "row_key", "saved", "shared_folder", "ship", "slices", "text_bytes"]

#: A word is a run of characters other than ASCII white space. On UTF-8 bytes, ``bytes.split()`` finds the same words.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, and only locally, without it, an own one."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="chartmill-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def saved(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read from there: lineage ends, and nothing is computed twice."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(name: str) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string").cast("binary"), F.lit(b""))


def map_arrow(
    df: DataFrame,
    carry: list[str],
    inputs: list[Column],
    run: Callable[[Iterable[pa.RecordBatch]], Iterator[list[pa.Array]]],
    added: dict[str, T.DataType],
) -> DataFrame:
    """Columns ``carry`` of ``df`` and new ones that ``run`` computes from Arrow batches of ``carry`` and then ``inputs``.

    ``run`` gives the arrays of carried and added columns. Inside, columns have neutral names, so that names with
    dots, or that clash with the added ones, do no harm. The driver's copy of this package reaches the workers.
    """
    ship(df.sparkSession)
    own, new = [f"c{i}" for i in range(len(carry))], [f"a{i}" for i in range(len(added))]
    kinds = [*[df.schema[c].dataType for c in carry], *added.values()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip([*own, *new], kinds)])

    def batches_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in run(batches):
            yield pa.RecordBatch.from_arrays(list(arrays), names=[*own, *new])

    columns = [*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, own)], *[x.alias(f"i{k}") for k, x in enumerate(inputs)]]
    out = df.select(*columns).mapInArrow(batches_out, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip([*own, *new], [*carry, *added])])


def slices(sizes: list[int], most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about ``most``; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def row_key(doc_id: str, text: str) -> list[Column]:
    """128 bits that tell a row by its id and text; rows that agree in both are repeated rows. Never null."""
    i, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    return [F.xxhash64(i, t, i.isNull()).alias("k1"), F.xxhash64(t, F.lit(7), i, t.isNull()).alias("k2")]


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under the names c0, c1, ..., so that added ones clash with none."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])


def named(df: DataFrame, names: list[str]) -> DataFrame:
    """Back to the names before :func:`numbered`; further columns stay as they are."""
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return df.select(*own, *[c for c in df.columns if c not in {f"c{i}" for i in range(len(names))}])


def dealt_again(c: Column) -> Column:
    """The same number, as an expression that the engine does not take for the column it is partitioned by.

    A join then shuffles this side too, which lets the adaptive engine split a hot key of the other.
    """
    return F.bitwise_not(F.bitwise_not(c))
