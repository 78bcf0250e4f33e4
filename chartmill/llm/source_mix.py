"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the mix. A source whose share would take it beyond the most epochs is
clamped there, and what it cannot take is reshared among the others in proportion to their weights, again and
again until no share is too large. A source then passes a whole number of times through all its documents and
a fraction of a time through some, drawn in the order of a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.llm.common import WORD, named, numbered, saved

#: Parts that the hash order of a source is cut into before one part is looked at closely.
PARTS = 4096
#: What a source's stop is told by, in turn: part of the order of ids, id, part of the rows of that id, row.
LEVELS = ("part", "h", "crowd", "th")
#: Equal rows that one array holds at most before they are rows again.
STRETCH = 1 << 16
#: Most sources whose limits are broadcast (some hundred bytes each).
FEW = 20_000


def words_in(text: str) -> Column:
    """Words of a whole text; null: none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, total: tuple[int, int], epochs: int) -> DataFrame:
    """``target`` (words, double) for sources with ``size`` (long) and ``weight`` (long, at least 1).

    The mix is ``total`` = (a, b): a/b of all words. No target is above ``epochs`` times its source's size; when all
    are clamped the mix is smaller than asked. Arithmetic is in whole numbers (of 1/b words) up to one last division.
    One row per source; each round reads a few sums to the driver. ``sources`` is saved first and may be large.
    """
    a, b = total
    table = saved(sources.withColumn("cap", F.col("size") * F.lit(epochs * b)).withColumn("full", F.lit(False)))
    while True:
        row = table.agg(
            (F.sum("size") * F.lit(a)).alias("all"),
            F.sum(F.when(F.col("full"), F.col("cap"))).alias("held"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weights"),
        ).first()
        left, weights = (row["all"] or 0) - (row["held"] or 0), row["weights"] or 0
        over = ~F.col("full") & (F.col("weight").cast("decimal(38,0)") * F.lit(left) > F.col("cap").cast("decimal(38,0)") * F.lit(weights))
        if not weights or not table.where(over).limit(1).count():
            break
        table = saved(table.withColumn("full", F.col("full") | over))
    share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(weights * b or 1))
    return table.withColumn("target", F.when(F.col("full"), F.col("size") * F.lit(float(epochs))).otherwise(share)).drop("cap", "full")


def _order(df: DataFrame, doc_id: str, seed: str) -> list[Column]:
    """Seeded order of documents: a hash of the id, then one of the whole row (maps and variants aside)."""
    i = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return [F.md5(F.concat(F.lit(seed), i)).alias("h"), F.xxhash64(*hashed).alias("th")]


def _narrowed(rows: DataFrame, picks: DataFrame, level: str) -> DataFrame:
    """Of each source's documents that agree with its pick on the levels so far, those of the ``level`` at which the words reach the rest."""
    picked = [c for c in picks.columns if c in LEVELS]
    met = rows.join(_small(picks.select(*[F.col(c).alias(f"p_{c}") for c in picks.columns])), F.col("src").eqNullSafe(F.col("p_src")))
    for c in picked:
        met = met.where(F.col(c) == F.col(f"p_{c}"))
    carried = [F.col(f"p_{c}").alias(c) for c in picks.columns if c not in ("words", "n")]
    return _reached(met.groupBy(*carried, level).agg(F.sum("size").alias("words"), F.count("*").alias("n")), level)


def _reached(sums: DataFrame, level: str) -> DataFrame:
    """The row of each source at which the words upto it, from ``before`` on, reach its ``rest``; ``before`` moves on to it."""
    running = Window.partitionBy("src").orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = sums.withColumn("upto", F.col("before") + F.sum("words").over(running))
    return saved(upto.where("upto >= rest AND upto - words < rest").withColumn("before", F.col("upto") - F.col("words")).drop("upto"))


def mix(
    df: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    total: tuple[int, int] = (3, 2),
    epochs: int = 2,
    seed: str = "mix:",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """All rows and columns of ``df``, and ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``
    (words), which replace columns of these names. ``copies`` is how often the mix takes the document: the whole part
    of its source's epochs, plus one for the documents that the fractional part draws.

    Sources weigh ``weights`` in turn, by code point, null last. Drawing goes through a source's documents in seeded
    order and stops where the words come nearest to the target, so the error of a source is half a document at most.
    The stop is found from sums: which 1/4096 of the order of ids holds it, which id there, which 1/4096 of that id's (or
    of all null ids') rows, and which row. So no task holds a source, nor an id that many rows share. Rows equal in all columns
    are drawn one by one too. Reruns agree. A null text has no words; sources without words take none. An empty table stays empty.
    """
    names = [c for c in df.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    at = {c: f"c{names.index(c)}" for c in (doc_id, text, source)}
    plain = numbered(df.select(*[F.col(f"`{c}`") for c in names]))
    rows = plain.select(
        "*", words_in(at[text]).alias("size"), *_order(plain, at[doc_id], seed)
    )
    part = F.conv(F.substring("h", 1, 3), 16, 10).cast("int")  # three hex digits: PARTS parts
    crowd = F.shiftright("th", 64 - (PARTS - 1).bit_length())  # as many parts of the rows of one id
    rows = rows.withColumns({"part": part, "crowd": crowd, "src": F.col(at[source])})
    by_part = saved(rows.groupBy("src", "part").agg(F.sum("size").alias("words")))

    # One row per source, in one window: its place decides its weight.
    place = Window.orderBy(F.col("src").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    sources = by_part.groupBy("src").agg(F.sum("words").alias("size")).withColumn("turn", turn)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).cast("long"))
    targets = saved(water_fill(weighed.drop("turn"), total, epochs)).withColumnRenamed("size", "source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )

    # Level by level, the place in each source's order at which the words reach the rest.
    wanted = targets.select(F.col("src").alias("t_src"), "rest")
    sums = by_part.join(wanted, F.col("src").eqNullSafe(F.col("t_src"))).drop("t_src").withColumn("before", F.lit(0).cast("long"))
    picks = _reached(sums, "part")
    for level in LEVELS[1:]:
        picks = _narrowed(rows, picks, level)
        if level == "h" and not picks.where("n > 1").limit(1).count():
            break  # an id of one row needs no further look
    if "th" not in picks.columns:
        picks = picks.withColumn("th", F.lit(None).cast("long"))
    # There: how many of the equal rows bring the words nearest to the rest.
    each = F.col("words") / F.col("n")
    fewer = F.floor((F.col("rest") - F.col("before")) / each).cast("long")
    off = [F.abs(F.col("before") + k * each - F.col("rest")) for k in (fewer, fewer + 1)]
    cuts = picks.select(F.col("src").alias("s_src"), F.col("h").alias("cut_h"), F.col("th").alias("cut_th"), "n", F.when(off[1] < off[0], fewer + 1).otherwise(fewer).alias("k"))
    limits = targets.join(cuts, F.col("src").eqNullSafe(F.col("s_src")), "left").select(
        F.col("src").alias("l_src"), "source_size", "target", "whole", "cut_h", "cut_th", "n", "k"
    )
    limits = saved(limits)
    here = (F.col("h") == F.col("cut_h")) & (F.col("cut_th").isNull() | (F.col("th") == F.col("cut_th")))
    earlier = (F.col("h") < F.col("cut_h")) | ((F.col("h") == F.col("cut_h")) & (F.col("th") < F.col("cut_th")))
    parted = here & F.col("k").between(1, F.col("n") - 1)
    placed = rows.join(_small(limits), F.col("src").eqNullSafe(F.col("l_src")))
    kept = [*[f"c{i}" for i in range(len(names))], "size", "source_size", "target", "whole"]
    drawn = (earlier | (here & (F.col("k") == F.col("n")))).alias("drawn")
    mixed = placed.select(*kept, drawn)
    if limits.where("k > 0 AND k < n").limit(1).count():
        mixed = placed.where(~F.coalesce(parted, F.lit(False))).select(*kept, drawn)
        mixed = mixed.unionByName(_some_of(placed.where(parted), kept))
    copies = F.col("whole") + F.when(F.col("size") > 0, F.coalesce("drawn", F.lit(False)).cast("long")).otherwise(0)
    out = mixed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return named(out.select(*kept[:-1], "copies", "taken"), names)


def _some_of(rows: DataFrame, kept: list[str]) -> DataFrame:
    """All the rows, ``k`` of each source ``drawn``: equal ones are counted, so they meet as one row, and dealt out again."""
    counted = rows.groupBy(*kept, "l_src", "k").agg(F.count("*").alias("m"))
    # One row per source, but where rows differ in columns that have no hash.
    upto = F.sum("m").over(Window.partitionBy("l_src").orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    told = counted.withColumn("of", F.col("k") - (upto - F.col("m")))
    stretches = told.withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(STRETCH).cast("long"))))
    dealt = stretches.withColumn("i", F.explode(F.sequence("a", F.least(F.col("a") + STRETCH, F.col("m")) - 1)))
    return dealt.select(*kept, (F.col("i") < F.col("of")).alias("drawn"))


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source when its rows have been counted to be few; else it joins by shuffle."""
    return F.broadcast(table) if table.count() <= FEW else table


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of the mix: each row of :func:`mix` as often as its ``copies`` say."""
    return mixed.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("copies")
