"""Encoding whole documents to token ids and back, in tasks of bounded memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.bpe import WINDOW, Bpe, StreamDecoder, StreamEncoder, decimals
from chartmill.llm.common import map_arrow, slices


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Bpe:
    """Read once in each Python process. The path must hold on every machine, as that of an installed package does."""
    return Bpe(path)


def encoded(bpe: Bpe, texts: list[str]) -> Iterator[list[str | np.ndarray]]:
    """For each text its stable pieces (learnt by then) and, from overlong ones, id arrays."""
    items: list[list[str | np.ndarray]] = []
    known: set[str] = set()
    for text in texts:
        if len(text) <= WINDOW:
            items.append(bpe.pieces(text))
            known.update(items[-1])
        else:
            stream = StreamEncoder(bpe)
            items.append([*stream.feed(text), *stream.finish()])
            known.update(x for x in items[-1] if isinstance(x, str))
    bpe.learn(known)
    yield from items


def windows(bpe: Bpe, text: str) -> Iterator[list[str | np.ndarray]]:
    """Stable pieces (learnt by then) and id arrays of an overlong text, window by window; none is kept for the next."""
    stream = StreamEncoder(bpe)
    for start in range(0, len(text), WINDOW):
        found = list(stream.feed(text[start : start + WINDOW]))
        bpe.learn(x for x in found if isinstance(x, str))
        yield found
    found = list(stream.finish())
    bpe.learn(x for x in found if isinstance(x, str))
    yield found


def packed(bpe: Bpe, items: list[str | np.ndarray]) -> bytes:
    """Ids as little-endian unsigned integers of the tokenizer's width."""
    memo = bpe.memo
    try:
        return b"".join(map(memo.__getitem__, items))
    except TypeError:  # an array among them
        return b"".join([memo[x] if isinstance(x, str) else x.astype(bpe.dtype).tobytes() for x in items])


def batches_of_texts(batch: pa.RecordBatch, at: int, most: int = 1 << 22) -> Iterator[tuple[int, list[str]]]:
    """Row numbers and texts, in slices of bounded size."""
    column = batch.column(at)
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in column]
    for start, end in slices(sizes, most):
        yield start, [t or "" for t in column.slice(start, end - start).to_pylist()]


def encode_documents(df: DataFrame, path: str, text: str = "text", tokens: str = "tokens", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if not given) and an array of the ids of each whole text.

    Encoding is that of the tokenizers library with the same file and no special tokens added; a special token's
    text in a document becomes its id, as there. A null text is empty: no ids. An existing column ``tokens`` is
    replaced. Repeated rows are encoded one by one; an empty table stays empty.
    """
    rest = [c for c in (df.columns if carry is None else carry) if c != tokens]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = tokenizer(path)
        for batch in batches:
            for start, texts in batches_of_texts(batch, len(rest), 1 << 20):
                ids = [np.frombuffer(packed(bpe, x), bpe.dtype) for x in encoded(bpe, texts)]
                ends = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate([np.zeros(0, bpe.dtype), *ids]).astype(np.int32))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield [*batch.slice(start, len(texts)).columns[: len(rest)], column]

    return map_arrow(df, rest, [F.col(f"`{text}`").cast("string")], run, {tokens: T.ArrayType(T.IntegerType(), False)})


def decode_documents(
    df: DataFrame, path: str, tokens: str = "tokens", text: str = "text", keep_tokens: bool = False
) -> DataFrame:
    """All columns of ``df`` (``tokens`` only if they are to be kept), and the text of its ids; special ids give their text.

    Ids pass through a state machine that holds back bytes only while they are the start of a character; bytes that
    are none become U+FFFD. Null ids give an empty text. An existing column ``text`` is replaced.
    """
    rest = [c for c in df.columns if c != text and (keep_tokens or c != tokens)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = []
            for ids in batch.column(len(rest)):
                values = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, np.int32)
                decoder = StreamDecoder(bpe)
                parts = [decoder.feed(values[i : i + 65536]) for i in range(0, len(values), 65536)]
                texts.append("".join([*parts, decoder.finish()]))
            yield [*batch.columns[: len(rest)], pa.array(texts, pa.string())]

    return map_arrow(df, rest, [F.col(f"`{tokens}`").cast("array<int>")], run, {text: T.StringType()})


def tokenised(df: DataFrame, path: str, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """All columns of ``df``, with the text replaced by what its ids decode to (the same text), and the ids.

    One pass over the rows: each text is encoded and its ids decoded again in the same task. Cases as in
    :func:`encode_documents`; a null text comes back empty.
    """
    rest = [c for c in df.columns if c not in (text, tokens)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = tokenizer(path)
        for batch in batches:
            for start, texts in batches_of_texts(batch, len(rest), 1 << 20):
                ids = [np.frombuffer(packed(bpe, x), bpe.dtype) for x in encoded(bpe, texts)]
                back = []
                for x in ids:
                    decoder = StreamDecoder(bpe)
                    back.append("".join([*(decoder.feed(x[i : i + 65536]) for i in range(0, len(x), 65536)), decoder.finish()]))
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                flat = pa.array(np.concatenate([np.zeros(0, bpe.dtype), *ids]).astype(np.int32))
                own = batch.slice(start, len(texts)).columns[: len(rest)]
                yield [*own, pa.array(back, pa.string()), pa.ListArray.from_arrays(ends, flat)]

    added = {text: T.StringType(), tokens: T.ArrayType(T.IntegerType(), False)}
    out = map_arrow(df, rest, [F.col(f"`{text}`").cast("string")], run, added)
    return out.select(*[F.col(f"`{c}`") for c in [*(c for c in df.columns if c != tokens), tokens]])


def round_trip_digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the ids (decimals, joined by commas) and of the decoded text.

    One pass: a document's ids leave the encoder, enter the decoder and are forgotten. Of a text of over ``WINDOW``
    characters a task holds the text itself, one window's pieces and ids, and the undecided end. Nulls as in
    :func:`encode_documents`; repeated rows are digested one by one, an empty table stays empty, and other columns
    are not looked at.
    """

    def digest(bpe: Bpe, parts: Iterable[list]) -> tuple[int, str, str]:
        of_ids, of_text, decoder = hashlib.sha256(), hashlib.sha256(), StreamDecoder(bpe)
        n = 0
        for items in parts:
            for start in range(0, len(items), 4096):
                part = items[start : start + 4096]
                ids = np.frombuffer(packed(bpe, part), bpe.dtype)
                if len(ids):
                    of_ids.update(b"," * bool(n))
                    of_ids.update(b",".join(d for x in part if (d := bpe.decimal(x) if isinstance(x, str) else decimals(x))))
                    of_text.update(decoder.feed(ids).encode())
                    n += len(ids)
        of_text.update(decoder.finish().encode())
        return n, of_ids.hexdigest(), of_text.hexdigest()

    def digests(bpe: Bpe, texts: list[str]) -> list[tuple[int, str, str]]:
        short = [t for t in texts if len(t) <= WINDOW]
        done = iter([digest(bpe, [items]) for items in encoded(bpe, short)])
        # Windows may make the memo forget pieces, so the short texts are through by then.
        return [next(done) if len(t) <= WINDOW else digest(bpe, windows(bpe, t)) for t in texts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = tokenizer(path)
        for batch in batches:
            for start, texts in batches_of_texts(batch, 1):
                columns = [pa.array(x, k) for x, k in zip(zip(*digests(bpe, texts)), (pa.int64(), pa.string(), pa.string()))]
                yield [batch.column(0).slice(start, len(texts)), *columns]

    added = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return map_arrow(df, [doc_id], [F.col(f"`{text}`").cast("string")], run, added)
