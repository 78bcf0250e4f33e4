"""Line deduplication by overlapping windows of three lines, in DataFrame functions alone.

Every three consecutive lines of a document are hashed (128 bits); a window without a word is none. A window that
occurs earlier in the corpus (by document id, then position, the same document included) is a repeat. The lines
that any repeated window covers are removed: overlapping windows merge by the positions that they cover. The first
occurrence always stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.common import named, numbered, row_key
from chartmill.llm.occurrences import later_occurrences

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column) -> Column:
    """Position and hashes of each window of a text."""
    lines = _lines(text)
    aligned = F.arrays_zip(*[F.slice(lines, k + 1, F.size(lines)).alias(f"l{k}") for k in range(WINDOW)])
    whole = F.slice(aligned, 1, F.greatest(F.size(lines) - (WINDOW - 1), F.lit(0)))

    def hashed(w: Column, at: Column) -> Column:
        parts = [w.getField(f"l{k}") for k in range(WINDOW)]
        return F.struct(
            at.alias("pos"),
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(1), *reversed(parts)).alias("h2"),
            F.concat(*parts).rlike(r"[^\x20\x09-\x0D]").alias("word"),
        )

    return F.transform(whole, hashed)


def _without(text: Column, starts: Column) -> tuple[Column, Column]:
    """The text without the lines of the windows that begin at ``starts``, and the number of lines left."""
    lines = _lines(text)
    covered = F.flatten(F.transform(starts, lambda p: F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: p + k)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    # A struct in an array of one binds the lines to a name: they are split once, not once per line.
    bound = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    picked = F.transform(bound, lambda s: F.transform(s["left"], lambda i: F.get(s["lines"], i)))
    return F.array_join(F.element_at(picked, 1), "\n"), F.size(left)


def remove_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = True) -> DataFrame:
    """All rows and columns of ``df`` with repeated lines taken out of the text; with ``counts`` also ``n_lines``
    (before) and ``n_removed``, which replace columns of these names.

    A document all of whose lines are repeats keeps its row, with an empty text. Fewer than three lines: unchanged.
    A null text stays null (no lines). Null ids come after all others. Rows that agree in id and text are one
    document and get one result. An empty table stays empty.
    """
    names = [c for c in df.columns if not counts or c not in ("n_lines", "n_removed")]
    at_id, at_text = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    keyed = numbered(df.select(*[F.col(f"`{c}`") for c in names])).select("*", row_key(at_id, at_text)[0])
    passages = (
        keyed.select(F.col(at_id).alias("id"), "k1", F.explode(_windows(F.col(at_text))).alias("w"))
        .where("w.word")
        .select("id", "k1", "w.pos", "w.h1", "w.h2")
    )
    # One row per document with repeats, and at most one position per line of it.
    starts = later_occurrences(passages).groupBy("id", "k1").agg(F.collect_set("pos").alias("starts"))
    starts = starts.withColumnRenamed("k1", "at")
    met = keyed.join(starts, F.col(at_id).eqNullSafe(F.col("id")) & (F.col("k1") == F.col("at")), "left")
    body, left = _without(F.col(at_text), F.col("starts"))
    n = F.when(F.col(at_text).isNull(), 0).otherwise(F.size(_lines(F.col(at_text))))
    repeats = F.col("starts").isNotNull()
    added = {"n_lines": n.cast("long"), "n_removed": F.when(repeats, n - left).otherwise(0).cast("long")} if counts else {}
    out = met.select(
        *[F.when(repeats, body).otherwise(F.col(c)).alias(c) if c == at_text else F.col(c) for c in (f"c{i}" for i in range(len(names)))],
        *[v.alias(k) for k, v in added.items()],
    )
    return named(out, names)
