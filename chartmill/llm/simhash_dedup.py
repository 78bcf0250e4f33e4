"""Near-duplicates by SimHash fingerprints and anchor points of a covering code.

**Fingerprint.** 64 bits over the three-word shingles of the text with A-Z lower-cased: a bit is one when it is
one in more than half of the shingles' XXH64 values (seed 42). Two texts are linked when their fingerprints
differ in three bits or fewer.

**Search.** Of three differing bits, one 32-bit half of the fingerprint has one at most. On each half lives a
covering code: the direct sum of perfect codes (Golay, Hamming, repetition, identity), whose words are the
anchors. A half lies within a block's covering radius of exactly one word per block, its home; when it differs
from another half in one bit, it lies within that radius plus one of the other's home in the block with that
bit, and within the radius in all others. So each fingerprint goes to its home and to every anchor within
radius plus threshold, and each anchor compares the fingerprints at home there with all that reach it. Every
linked pair meets. The code grows with the number of distinct fingerprints, so anchors stay small; this changes
the cost, never the links.

**Skew.** Equal fingerprints are one row before any of this. An anchor that many different fingerprints reach is
cut into cells of bounded size, in which blocks of homes meet blocks of members. A cell hands on a spanning
forest of its links, not the pairs; components of all forests give the groups.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import dealt_again, map_arrow, numbered, row_key, saved, ship
from chartmill.llm.components import components

SHINGLE = 3
THRESHOLD = 3
#: Most fingerprints on a side of a cell; more at one anchor are cut into several cells.
CELL = 8192
#: Fingerprints at home at an anchor, on average, up to which a smaller code serves.
HOMES = 64


def fingerprint(data: bytes, seed: int = 42) -> int:
    """SimHash of a whole UTF-8 text; no words: zero; fewer than three words: one shingle of all."""
    words = data.lower().split()
    n = max(len(words) - SHINGLE + 1, 1)
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = words[start : start + (1 << 16) + SHINGLE - 1]
        shingles = zip(*[part[i:] for i in range(SHINGLE)]) if len(words) >= SHINGLE else [part]
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), seed) for s in shingles), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@dataclass(frozen=True)
class PerfectCode:
    """A linear code in which every word of ``length`` bits is within ``radius`` of exactly one code word.

    ``columns[i]`` is the syndrome of bit i.
    """

    length: int
    radius: int
    columns: tuple[int, ...]

    @property
    def bits(self) -> int:
        """Code words, as a power of two."""
        return self.length - max(self.columns).bit_length()

    @cached_property
    def _patterns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Error of each syndrome up to the radius; start and errors of those one beyond it."""
        size = 1 << max(self.columns).bit_length()
        leader, beyond = np.zeros(size, np.int64), [[] for _ in range(size)]
        for weight in range(1, self.radius + 2):
            for at in itertools.combinations(range(self.length), weight):
                error = syndrome = 0
                for i in at:
                    error |= 1 << i
                    syndrome ^= self.columns[i]
                if weight <= self.radius:
                    leader[syndrome] = error
                else:
                    beyond[syndrome].append(error)
        starts = np.cumsum([0, *map(len, beyond)])
        return leader, starts, np.array(list(itertools.chain(*beyond)), np.int64)

    @cached_property
    def _syndromes(self) -> list[np.ndarray]:
        """Syndromes of the bytes of a word."""
        tables = []
        for low in range(0, self.length, 8):
            table = np.zeros(256, np.int64)
            for i in range(low, min(low + 8, self.length)):
                table[(np.arange(256) >> (i - low)) & 1 == 1] ^= self.columns[i]
            tables.append(table)
        return tables

    def _syndrome(self, words: np.ndarray) -> np.ndarray:
        found = np.zeros(len(words), np.int64)
        for k, table in enumerate(self._syndromes):
            found ^= table[(words >> (8 * k)) & 255]
        return found

    def home(self, words: np.ndarray) -> np.ndarray:
        return words ^ self._patterns[0][self._syndrome(words)]

    def beyond(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code words at distance radius + 1, as (index of the word, code word)."""
        _, starts, errors = self._patterns
        s = self._syndrome(words)
        counts = starts[s + 1] - starts[s]
        row = np.repeat(np.arange(len(words)), counts)
        step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        return row, words[row] ^ errors[starts[s][row] + step]


def _golay() -> PerfectCode:
    columns = []
    for i in range(23):
        word = 1 << i
        for k in range(22, 10, -1):
            if word >> k & 1:
                word ^= 0b101011100011 << (k - 11)
        columns.append(word)
    return PerfectCode(23, 3, tuple(columns))


def _hamming(r: int) -> PerfectCode:
    return PerfectCode((1 << r) - 1, 1, tuple(range(1, 1 << r)))


def _repetition(n: int) -> PerfectCode:
    return PerfectCode(n, n // 2, (*[1 << i for i in range(n - 1)], (1 << (n - 1)) - 1))


def _identity(n: int) -> PerfectCode:
    return PerfectCode(n, 0, (0,) * n)


@cache
def codes() -> list[list[PerfectCode]]:
    """Codes on 32 bits with 2^13, 2^18 and 2^27 anchors."""
    return [[_golay(), _repetition(9)], [_golay(), _hamming(3), _identity(2)], [_hamming(5), _identity(1)]]


def code_for(n: int) -> int:
    """The smallest code that leaves few fingerprints at home at an anchor."""
    for k, blocks in enumerate(codes()):
        if n <= HOMES << sum(c.bits for c in blocks):
            return k
    return len(codes()) - 1


def anchors(half: np.ndarray, code: list[PerfectCode]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, anchor, is home) of 32-bit values: the home, and every anchor one bit beyond the radius in one block."""
    homes, low = [], 0
    for c in code:
        homes.append(c.home((half >> low) & ((1 << c.length) - 1)) << low)
        low += c.length
    home = np.bitwise_or.reduce(homes)
    rows, found, flags = [np.arange(len(half))], [home], [np.ones(len(half), bool)]
    low = 0
    for c, own in zip(code, homes):
        row, word = c.beyond((half >> low) & ((1 << c.length) - 1))
        rows.append(row)
        found.append((home[row] ^ own[row]) | (word << low))
        flags.append(np.zeros(len(row), bool))
        low += c.length
    return np.concatenate(rows), np.concatenate(found), np.concatenate(flags)


def forest(homes: np.ndarray, members: np.ndarray, most: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links (home, member) at ``most`` differing bits that connect all that such links connect."""
    # Of signed numbers, numpy counts the bits of the absolute value.
    signed, targets = homes, members
    homes, members = homes.view(np.uint64), members.view(np.uint64)
    label = {int(v): i for i, v in enumerate(np.unique(np.concatenate([homes, members])))}
    of_home = np.array([label[int(v)] for v in homes])
    of_member = np.array([label[int(v)] for v in members])
    labels, links = np.arange(len(label)), []
    step = max(1, (1 << 21) // max(len(members), 1))
    for start in range(0, len(homes), step):
        part = homes[start : start + step]
        near = np.bitwise_count(part[:, None] ^ members[None, :]) <= most
        own = of_home[start : start + step]
        for i in np.flatnonzero(near.sum(axis=1) > 0):
            j = np.flatnonzero(near[i])
            there = labels[of_member[j]]
            mine = labels[own[i]]
            if (there == mine).all():
                continue
            roots, first = np.unique(there, return_index=True)
            links += [(int(signed[start + i]), int(targets[j[k]])) for r, k in zip(roots, first) if r != mine]
            labels[np.isin(labels, roots)] = mine
    return links


def fingerprints(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """Columns ``carry`` and the fingerprint of each row's whole text as a signed 64-bit number. Null text: zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = batch.column(len(carry)).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
            yield [*batch.columns[: len(carry)], pa.array(prints.view(np.int64))]

    return map_arrow(df, list(carry), [F.col(f"`{text}`").cast("string")], run, {name: T.LongType()})


def links(prints: DataFrame, name: str = "fp") -> DataFrame:
    """(a, b): links that connect all fingerprints of the column at three differing bits or fewer.

    Repeated fingerprints count once; nulls take no part; an empty table gives no rows.
    """
    ship(prints.sparkSession)
    distinct = saved(prints.where(f"`{name}` IS NOT NULL").select(F.col(f"`{name}`").alias("fp")).distinct())
    chosen = code_for(distinct.count())

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codes()[chosen]
        for batch in batches:
            values = batch.column(0).to_numpy()
            for start in range(0, len(values), 1 << 15):
                fp = values[start : start + (1 << 15)]
                for side in (0, 1):
                    half = (fp >> (32 * side)) & 0xFFFFFFFF
                    row, anchor, home = anchors(half, code)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor * 2 + side), pa.array(fp[row]), pa.array(home)], names=["anchor", "fp", "home"]
                    )

    placed = distinct.mapInArrow(spread, "anchor bigint, fp bigint, home boolean")
    sizes = placed.groupBy("anchor").agg(F.count("*").alias("members"), F.count_if("home").alias("homes"))
    # Only anchors that one cell does not hold; without any the join below is with nothing.
    crowded = sizes.where(f"members > {CELL} AND homes > 0").select(
        F.col("anchor").alias("at"),
        F.ceil(F.col("members") / CELL).cast("int").alias("m_parts"),
        F.ceil(F.col("homes") / CELL).cast("int").alias("h_parts"),
    )
    cut = placed.join(crowded, F.col("anchor") == F.col("at"), "left")
    m_parts, h_parts = F.coalesce("m_parts", F.lit(1)), F.coalesce("h_parts", F.lit(1))
    m_own, h_own = F.pmod(F.xxhash64("fp"), m_parts).cast("int"), F.pmod(F.xxhash64("fp", F.lit(1)), h_parts).cast("int")
    as_member = cut.select(
        "anchor", F.explode(F.sequence(F.lit(0), h_parts - 1)).alias("h"), m_own.alias("m"), "fp", F.lit(False).alias("home")
    )
    as_home = cut.where("home").select(
        "anchor", h_own.alias("h"), F.explode(F.sequence(F.lit(0), m_parts - 1)).alias("m"), "fp", F.lit(True).alias("home")
    )
    cells = as_home.unionByName(as_member).repartition("anchor", "h", "m").sortWithinPartitions("anchor", "h", "m")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, home, fp in _runs(batches):
            found = forest(fp[home], fp[~home]) if home.any() else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cells.mapInArrow(compare, "a bigint, b bigint")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """The rows of each cell of batches that are sorted by cell: a cell may span batches, and is bounded in size."""
    held: list[np.ndarray] = []
    key = None
    for batch in batches:
        anchor, h, m, fp, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(fp):
            continue
        turns = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(h) != 0) | (np.diff(m) != 0)) + 1
        for s, e in zip([0, *turns], [*turns, len(fp)]):
            now = (anchor[s], h[s], m[s])
            if key is not None and now != key:
                yield key, np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
                held = []
            key = now
            held.append((home[s:e], fp[s:e]))
    if held:
        yield key, np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])


def _groups(prints: DataFrame) -> DataFrame:
    """(fp, root) of all linked fingerprints."""
    return components(links(prints), "a", "b").select(F.col("node").alias("fp"), "root")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` among all documents that chains of links reach, itself included.
    A null or empty text has fingerprint zero and is linked like any other. A null ``doc_id`` never names a
    component; one without any other id has a null ``component_id``. Repeated rows stay, in one component. An
    empty table gives an empty result. Other columns of ``df`` are not looked at.
    """
    prints = saved(fingerprints(df, text, (doc_id,)).select(F.col(f"`{doc_id}`").alias("doc_id"), "fp"))
    each = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = each.join(_groups(prints).withColumnRenamed("fp", "node"), F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    lowest = lowest.select(dealt_again(F.col("root")).alias("of"), "component_id")
    named = rooted.join(lowest, F.col("root") == F.col("of")).select(F.col("fp").alias("key"), "component_id")
    return prints.join(named, F.col("fp") == F.col("key")).select(
        F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that are first in their group of near-duplicates, with all their columns.

    First is the smallest ``doc_id`` (nulls last), then the smallest hash of the text; of rows that agree in id and
    text one stays. Texts with no word are one group. A text is moved once, to meet the decision on it.
    """
    names = df.columns
    at_id, at_text = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    keyed = numbered(df).select("*", *row_key(at_id, at_text))
    prints = saved(fingerprints(keyed, at_text, (at_id, "k1", "k2")))
    first = F.min(F.struct(F.col(at_id).isNull().alias("n"), F.col(at_id).alias("i"), "k1", "k2"))
    each = prints.groupBy("fp").agg(first.alias("first"))
    grouped = each.join(_groups(prints).withColumnRenamed("fp", "node"), F.col("fp") == F.col("node"), "left")
    stay = (
        grouped.groupBy(F.coalesce("root", "fp").alias("of"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"))
    )
    kept = keyed.join(stay, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
