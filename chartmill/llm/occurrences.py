"""First and later occurrences of hashed passages over a whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.llm.common import dealt_again, saved


def later_occurrences(passages: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The rows whose passage (``h1``, ``h2``) occurs earlier too, by document (``id``, nulls last; then ``k1``) and ``pos``.

    Repeated rows of one document are one occurrence. Passages are counted inside the map tasks first; only those
    that occur more than once are looked at further, and few rows have one. Both joins shuffle two sides, so that a
    passage in very many documents is split over tasks; nothing is gathered per passage. ``repeated`` may hold each
    ``h1`` that occurs more than once, if it has been found already.
    """
    if repeated is None:
        repeated = passages.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    some = saved(passages.join(saved(repeated), repeated.columns, "left_semi"))
    place = F.struct(F.col("id").isNull().alias("n"), "id", "k1", "pos")
    firsts = some.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    firsts = firsts.select(dealt_again(F.col("h1")).alias("f1"), dealt_again(F.col("h2")).alias("f2"), "first")
    on = (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))
    return some.join(firsts, on).where(place > F.col("first")).drop("f1", "f2", "first")
