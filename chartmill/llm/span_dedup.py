"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences: after ``.``, ``!`` or ``?`` before white space, and after each line break. A sentence
of more than 8 words is cut further, at places that its words choose: of any 8 words in a row (its last one aside),
it is cut after the one whose hash, with the next word, is least. In two copies of a passage these cuts are the
same but near its ends, whatever stands before it. Pairs of words that stand twice within 10 words are not chosen;
where no pair is, as in a phrase said over and over, pieces have 16 words, counted from the last cut. From each piece
with a word starts one span: the shortest run of at least two pieces that has 24 words or more. Spans are compared
by 96 bits of the hash of their words, so white space does not matter. Spans that occur earlier in the corpus (by
document id, then position, the same document included) are repeats, and the pieces that any repeat covers are
removed. The first occurrence always stays, as does all else, to the character.

A passage of 24 words more than some 8 to 20 at either end, where the cuts of copies can differ, is therefore found
wherever it is copied to. A span starts at each piece and none is sought backwards from a passage's end, so that
less than a piece of those words more can stay there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import named, numbered, row_key, ship, slices

MOST_WORDS = 16
#: Of so many words in a row one is cut after, unless it and the next stand again within the next or last few words.
WINDOW = 8
RECUR = 10
NEVER = np.uint64((1 << 64) - 1)
SPAN_WORDS = 24
SPAN_SENTENCES = 2
#: Bytes of text that are cut at once (a longer text alone), and bytes of them whose words are hashed at once.
TEXT_BYTES = 1 << 19
WORD_BYTES = 1 << 18
#: Spans that a task holds before it compares them.
HELD = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
#: Odd factors of the sums that words and runs of words are hashed by.
_BYTE_FACTOR = 0x9E3779B97F4A7C15
_RUN_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_RUN_FACTORS[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_BYTE_FACTOR)
    return x ^ (x >> np.uint64(32))


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each word: its bytes by powers of a factor, summed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = _powers(_BYTE_FACTOR, int(lengths.max()))
    out = np.empty(len(starts), np.uint64)
    upto = np.cumsum(lengths)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + WORD_BYTES, "right")))
        n = lengths[a:b]
        first = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        terms = (buf[within + np.repeat(starts[a:b], n)].astype(np.uint64) + np.uint64(1)) * powers[within]
        out[a:b] = np.add.reduceat(terms, first)
        a = b
    return _mixed(out)


def _chosen(words: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Whether a long sentence is cut before each word."""
    n = len(words)
    pair = np.zeros(n, bool)
    pair[:-1] = sentence[1:] == sentence[:-1]
    hashes = words.copy()
    hashes[:-1] = _mixed(words[:-1] * np.uint64(_RUN_FACTORS[1]) + words[1:])
    recurs = np.zeros(n, bool)
    for k in range(1, min(RECUR, n - 1) + 1):
        same = (hashes[k:] == hashes[:-k]) & (sentence[k:] == sentence[:-k]) & pair[k:]
        recurs[k:] |= same
        recurs[:-k] |= same
    hashes[recurs] = NEVER
    # How many pairs in a row before and after this one, of its sentence, have greater hashes.
    room = np.ones(n, np.int8)
    before, after = pair & ~recurs, pair & ~recurs
    least = before.copy()
    for k in range(1, min(WINDOW - 1, n - 1) + 1):
        alike = (sentence[k:] == sentence[:-k]) & pair[k:]
        before[k:] &= alike & (hashes[:-k] > hashes[k:])
        before[:k] = False
        after[:-k] &= alike & (hashes[k:] > hashes[:-k])
        after[-k:] = False
        room += before
        room += after
    cut = np.zeros(n, bool)
    cut[1:] = (least & (room >= WINDOW))[:-1]
    return cut


class _Cut(NamedTuple):
    """Pieces and spans of several texts."""

    #: First byte of each piece and the end of the last, and the first piece of each text, in the joined texts.
    pieces: list[np.ndarray]
    #: Text, piece it starts with, number of pieces and the two hashes of each span.
    row: np.ndarray
    pos: np.ndarray
    covers: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


def _cut(texts: list[bytes]) -> _Cut:
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = _SPACE[buf]
    mark = np.zeros(len(buf) + 1, bool)
    mark[1:] = buf == ord("\n")
    mark[1:-1] |= _STOP[buf[:-1]] & space[1:]
    mark[begins] = True
    mark[begins + sizes] = False
    mark = mark[:-1]

    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = _word_hashes(buf, starts, ends)
    sentence = np.searchsorted(np.flatnonzero(mark), starts, "right")
    opens = np.ones(len(words), bool)
    opens[1:] = sentence[1:] != sentence[:-1]
    if len(words) > WINDOW:
        opens |= _chosen(words, sentence)
    index = np.arange(len(words))
    since = index - np.maximum.accumulate(np.where(opens, index, 0))
    opens |= since % MOST_WORDS == 0
    mark[starts[opens & (np.diff(sentence, prepend=0) == 0)]] = True

    bounds = np.flatnonzero(mark)
    own = np.searchsorted(bounds, np.append(begins, len(buf)))
    pieces = [np.append(bounds[a:b] - s, n) for a, b, s, n in zip(own, own[1:], begins, sizes)]

    first = np.flatnonzero(opens)
    piece = np.searchsorted(bounds, starts[first], "right") - 1
    row = np.searchsorted(begins, starts[first], "right") - 1
    upto = np.append(first, len(words))
    end = np.maximum(np.searchsorted(upto, first + SPAN_WORDS), np.arange(len(first)) + SPAN_SENTENCES)
    some = np.flatnonzero(end <= np.searchsorted(row, row, "right"))
    end = end[some]
    runs = []
    for k, factor in enumerate(_RUN_FACTORS):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(_mixed(words + np.uint64(k)) * _powers(factor, len(words)), out=sums[1:])
        back = _powers(pow(factor, -1, 1 << 64), len(words))
        runs.append(_mixed((sums[upto[end]] - sums[first[some]]) * back[first[some]]))
    return _Cut(
        pieces,
        row[some],
        (piece[some] - own[row[some]]).astype(np.int32),
        (piece[end - 1] - piece[some] + 1).astype(np.int32),
        runs[0].view(np.int64),
        (runs[1] >> np.uint64(32)).astype(np.uint32).view(np.int32),
    )


def _cuts(column: pa.Array) -> Iterator[tuple[int, list[bytes], _Cut]]:
    """A column of texts in runs of bounded size: the first row, the texts (null: empty), and how they are cut."""
    raw = column.cast(pa.binary())
    for a, b in slices(pc.fill_null(pc.binary_length(raw), 0).to_pylist(), TEXT_BYTES):
        texts = [t or b"" for t in raw.slice(a, b - a).to_pylist()]
        yield a, texts, _cut(texts)


def sentences(text: str) -> list[str]:
    """The text in order, cut into sentences and pieces of long ones; joined they are the text again."""
    raw = text.encode()
    at = _cut([raw]).pieces[0].tolist()
    return [raw[a:b].decode() for a, b in zip(at, at[1:])]


def _without(text: bytes, pieces: np.ndarray, pos: np.ndarray, covers: np.ndarray, starts: list[int]) -> tuple[bytes, int]:
    """The text without the pieces of the spans that begin at ``starts``, and the number of those removed."""
    at = np.array(starts)
    change = np.zeros(len(pieces), np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + covers[np.searchsorted(pos, at)], -1)
    kept = np.cumsum(change[:-1]) == 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]).astype(np.int8)))
    ends = pieces[turns].tolist()
    return b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])), int((~kept).sum())


def _later(texts: DataFrame) -> DataFrame:
    """``id``, ``k1`` and ``pos`` of each span that occurs earlier too, by document (``id``, nulls last; then ``k1``) and ``pos``.

    A task compares its own spans first, a million at a time: of those alike all but the first are later ones whatever
    the others hold, and only the first goes where its hash tells. So a hot hash has one row per million spans where
    it is compared, however often it occurs; the rows that are told already are dealt anywhere.
    """
    schema = T.StructType(
        [
            T.StructField("id", texts.schema["id"].dataType),
            T.StructField("k1", T.LongType()),
            T.StructField("mark", T.LongType()),
            T.StructField("at", T.LongType()),
        ]
    )

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[pa.RecordBatch] = []
        held: list[tuple[np.ndarray, ...]] = []
        rows = spans = 0
        for batch in batches:
            for a, own, cut in _cuts(batch.column(2)):
                keys.append(batch.select([0, 1]).slice(a, len(own)))
                held.append((cut.row + rows, cut.pos, cut.h1, cut.h2))
                rows += len(own)
                spans += len(cut.pos)
                if spans >= HELD:
                    yield from told(keys, held)
                    keys, held, rows, spans = [], [], 0, 0
        if held:
            yield from told(keys, held)

    def told(keys: list[pa.RecordBatch], held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        documents = pa.Table.from_batches(keys).combine_chunks()
        row, pos, h1, h2 = (np.concatenate(x) for x in zip(*held))
        if not len(row):
            return
        order = pc.sort_indices(documents, sort_keys=[("id", "ascending"), ("k1", "ascending")]).to_numpy()
        k1 = documents.column("k1").to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(np.diff(k1[order], prepend=k1[order[:1]]) != 0)
        place = (rank[row] << 32) + pos
        order = np.lexsort((place, h2, h1))
        h1, h2, place = h1[order], h2[order], place[order]
        opens = np.ones(len(order), bool)
        opens[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = place[np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))]
        later = place > first
        # In the order of the texts again, where neighbours share their keys.
        stay = np.flatnonzero(opens | later)
        stay = stay[np.argsort(order[stay])]
        row, pos, h1, h2, later = row[order[stay]], pos[order[stay]].astype(np.int64), h1[stay], h2[stay].astype(np.int64), later[stay]
        mark = (h2 << 32) | (later.astype(np.int64) << 31) | pos
        spread = _mixed(k1[row].view(np.uint64) + pos.view(np.uint64)).view(np.int64)
        found = documents.take(pa.array(row)).append_column("mark", pa.array(mark)).append_column("at", pa.array(np.where(later, spread, h1)))
        yield from found.to_batches(max_chunksize=1 << 16)

    # Dealt by one column, so that nothing computed from the others travels along.
    dealt = texts.mapInArrow(find, schema).repartition("at")
    mark = F.col("mark")
    read = dealt.select(
        "id",
        "k1",
        "at",
        F.shiftright(mark, 32).alias("h2"),
        (F.shiftright(mark, 31).bitwiseAND(1) == 1).alias("later"),
        mark.bitwiseAND((1 << 31) - 1).cast("int").alias("pos"),
    )
    alike = Window.partitionBy("at", "h2").orderBy(F.asc_nulls_last("id"), "k1", "pos")
    return read.withColumn("rank", F.rank().over(alike)).where("later OR rank > 1").select("id", "k1", "pos")


def remove_repeated_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with repeated spans taken out of the text, and ``n_sentences`` (before) and
    ``n_removed``, which replace columns of these names.

    A document of repeats alone keeps its row, with an empty text. Texts with no span are unchanged. A null text stays
    null (no sentences). Null ids come after all others. Rows that agree in id and text are one document and get one
    result. An empty table stays empty.
    """
    ship(df.sparkSession)
    names = [c for c in df.columns if c not in ("n_sentences", "n_removed")]
    at_id, at_text = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    keyed = numbered(df.select(*[F.col(f"`{c}`") for c in names])).select("*", row_key(at_id, at_text)[0])
    texts = keyed.select(F.col(at_id).alias("id"), "k1", F.col(at_text).alias("text"))
    # One row per document with repeats, and at most one span per sentence of it.
    starts = _later(texts).groupBy("id", "k1").agg(F.collect_set("pos").alias("starts"))
    starts = starts.withColumnRenamed("k1", "at")
    met = keyed.join(starts, F.col(at_id).eqNullSafe(F.col("id")) & (F.col("k1") == F.col("at")), "left")
    met = met.select(*[f"c{i}" for i in range(len(names))], "starts")
    place = names.index(text)

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = batch.column(place).is_valid().to_pylist()
            starts = batch.column(len(names)).to_pylist()
            texts: list[bytes | None] = []
            before, gone = [], []
            for a, own, cut in _cuts(batch.column(place)):
                upto = np.searchsorted(cut.row, np.arange(len(own) + 1))
                for i, t in enumerate(own):
                    body, removed = t, 0
                    if starts[a + i]:
                        of = slice(upto[i], upto[i + 1])
                        body, removed = _without(t, cut.pieces[i], cut.pos[of], cut.covers[of], starts[a + i])
                    texts.append(body if there[a + i] else None)
                    before.append(len(cut.pieces[i]) - 1)
                    gone.append(removed)
            columns = [*batch.columns[: len(names)]]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())], names=out.names)

    counts = [T.StructField(c, T.LongType()) for c in ("n_sentences", "n_removed")]
    out = T.StructType([*[met.schema[f"c{i}"] for i in range(len(names))], *counts])
    return named(met.mapInArrow(remove, out), names)
