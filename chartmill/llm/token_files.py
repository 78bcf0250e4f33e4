"""Token ids as flat binary files.

A folder holds parts, in ascending document order. Each part has

* ``ids``: the ids of its documents one after the other, little-endian unsigned, 16 bits each if the vocabulary
  allows and else 32;
* ``offsets``: one more 64-bit number than documents; document i has the ids from offset i to offset i + 1, counted
  over **all** parts;
* ``keys``: per document its 64-bit id and one byte (1, or 0 for a null id).

``index.json`` lists the parts with their file names, documents, ids and bases. Files are flat, so readers map them
into memory and touch the pages that they need.

Documents are dealt into ranges of their ids; a task encodes its range as a stream and writes ids and lengths. The
bases of parts are prefix sums over one row a part, which the driver holds; a second, small job turns lengths into
offsets. Names contain the task's attempt and only finished tasks are listed, so lost and repeated tasks do no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.llm.common import shared_folder, ship
from chartmill.llm.token_streams import batches_of_texts, encoded, packed, tokenizer

KEY = np.dtype([("id", "<i8"), ("known", "u1")])


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    """A folder that all machines see: a local path (shared), or a URI that Arrow's file systems know."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _put(folder: str, name: str, data: bytes) -> None:
    fs, path = _place(folder)
    with fs.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def _mapped(folder: str, name: str, dtype) -> np.ndarray:
    """A flat file as an array: mapped where the file system is local, else read."""
    fs, path = _place(folder)
    if fs.get_file_info(f"{path}/{name}").size == 0:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype, "r")
    with fs.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_token_files(
    df: DataFrame,
    folder: str,
    path: str,
    end_id: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> list[dict]:
    """Encode the whole texts of ``df`` with the tokenizer file ``path``, each with ``end_id`` at its end, and write
    them to ``folder`` in ascending ``doc_id`` order. Gives the parts as listed in ``index.json``.

    Null ids come last; rows with the same id follow each other by a hash of the text, so that an id in very many
    rows is spread over tasks. A null or empty text has the end id alone. Repeated rows are written one by one. An
    empty table gives an index with no documents. Other columns are not looked at.
    """
    spark = df.sparkSession
    ship(spark)
    fs, at = _place(folder)
    fs.create_dir(at, recursive=True)
    # Keys over the whole range of ids and, among equal ids, of texts.
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, context = tokenizer(path), TaskContext.get()
        end = np.array([] if end_id is None else [end_id], bpe.dtype).tobytes()
        width = bpe.dtype.itemsize
        part = context.partitionId()
        name = f"part-{part:05d}-{context.taskAttemptId()}"
        lengths, keys = [np.zeros(0, "<i8")], [np.zeros(0, KEY)]
        store, base = _place(folder)
        with store.open_output_stream(f"{base}/{name}.ids") as out:
            for batch in batches:
                ids = batch.column(0)
                key = np.zeros(len(batch), KEY)
                key["id"] = ids.fill_null(0).to_numpy()
                key["known"] = ids.is_valid().to_numpy(zero_copy_only=False)
                keys.append(key)
                for _, texts in batches_of_texts(batch, 1):
                    found = [packed(bpe, items) + end for items in encoded(bpe, texts)]
                    lengths.append(np.fromiter((len(x) // width for x in found), "<i8", len(found)))
                    out.write(b"".join(found))
        n = np.concatenate(lengths)
        _put(folder, f"{name}.lengths", n.tobytes())
        _put(folder, f"{name}.keys", np.concatenate(keys).tobytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "width": width, "documents": len(n), "ids": int(n.sum())}])

    found = rows.mapInArrow(write, "part long, name string, width long, documents long, ids long").collect()
    parts = [r.asDict() for r in sorted(found, key=lambda r: r["part"]) if r["documents"]]
    bases = [0, *accumulate(p["ids"] for p in parts)]
    for p, base in zip(parts, bases):
        p["base"] = base

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                lengths = _mapped(folder, f"{p['name']}.lengths", "<i8")
                offsets = np.cumsum(np.append(p["base"], lengths), dtype="<i8")
                _put(folder, f"{p['name']}.offsets", offsets.tobytes())
                yield pa.RecordBatch.from_pylist([{"last": int(offsets[-1])}])

    if parts:
        ends = {r["last"] for r in _listed(spark, parts).mapInArrow(place, "last long").collect()}
        assert ends == set(bases[1:])
    _put(folder, "index.json", json.dumps({"parts": parts, "end_id": end_id}).encode())
    return parts


def _listed(spark: SparkSession, parts: list[dict]) -> DataFrame:
    """One row a part, one task a part."""
    table = spark.createDataFrame([(p["name"], p["width"], p["base"]) for p in parts], "name string, width long, base long")
    return table.repartition(len(parts))


def read_index(folder: str) -> list[dict]:
    fs, path = _place(folder)
    with fs.open_input_stream(f"{path}/index.json") as f:
        return json.loads(f.read())["parts"]


def document_ids(folder: str, parts: list[dict], i: int) -> np.ndarray:
    """Ids of the i-th document in the folder, by mapping one part's files."""
    for p in parts:
        if i < p["documents"]:
            offsets = _mapped(folder, f"{p['name']}.offsets", "<i8")
            ids = _mapped(folder, f"{p['name']}.ids", f"<u{p['width']}")
            return ids[offsets[i] - p["base"] : offsets[i + 1] - p["base"]]
        i -= p["documents"]
    raise IndexError(i)


def read_token_files(spark: SparkSession, folder: str, doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """A row per document of a folder: its id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of the ids as 32-bit little-endian numbers) and, if asked for, ``ids``. Parts are mapped one at a time."""
    ship(spark)
    schema = f"`{doc_id}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    parts = read_index(folder)
    if not parts:
        return spark.createDataFrame([], schema)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                ids = _mapped(folder, f"{p['name']}.ids", f"<u{p['width']}")
                offsets = _mapped(folder, f"{p['name']}.offsets", "<i8")
                keys = _mapped(folder, f"{p['name']}.keys", KEY)
                for s in range(0, len(keys), 2048):
                    some = keys[s : s + 2048]
                    starts = np.asarray(offsets[s : s + len(some) + 1])
                    texts = [ids[a:b] for a, b in zip(starts[:-1] - p["base"], starts[1:] - p["base"])]
                    columns = [
                        pa.array(some["id"], pa.int64(), mask=some["known"] == 0),
                        pa.array(starts[:-1]),
                        pa.array(np.diff(starts)),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in texts], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in texts], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=[doc_id, "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return _listed(spark, parts).mapInArrow(read, schema)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
