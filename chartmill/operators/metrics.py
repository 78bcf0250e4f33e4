"""Metrics of binary classifiers as DataFrames.

Scored rows are first merged into one row per distinct score; everything that needs an order of the
scores runs on that table, in slices (see :mod:`chartmill.operators.ordered`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmill.functions import band, col_of, flag
from chartmill.operators.ordered import running_totals
from chartmill.operators.stages import written
from chartmill.workers import ship

#: Rows whose scores a task sorts at once, and rows of a slice of scores aimed for.
SORTED, SLICE_ROWS = 1 << 18, 1 << 19
#: Rows drawn for each slice to find where it starts.
DRAWN = 64

# Bands of the train/test gap in percentage points.
GAP_CUTS = [15.0, 5.0]
GAP_NAMES = ["high", "moderate", "low"]
GAP_WARNING = 10.0


def _safe(num: Column, den: Column) -> Column:
    """Quotient, 0 where it is undefined."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _safe(F.lit(2.0) * precision * recall, precision + recall)


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("bigint") if weight is None else col_of(weight).cast("double")


def score_counts(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """(score, pos, neg): weight of positives and negatives per distinct score."""
    w, y = _weight(weight), col_of(label)
    known = y.isNotNull() & col_of(score).isNotNull()
    return (
        df.where(known)
        .groupBy(col_of(score).cast("double").alias("score"))
        .agg(F.sum(F.when(y == 1, w).otherwise(0)).alias("pos"), F.sum(F.when(y == 1, 0).otherwise(w)).alias("neg"))
    )


def roc_curve(df: DataFrame, label: str, score: str, drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) by falling threshold, from (0, 0) at a null threshold to (1, 1).

    ``drop_intermediate`` leaves out points on a straight horizontal or vertical stretch.
    """
    counts = score_counts(df, label, score)
    beside = ["pos", "neg"] if drop_intermediate else []
    points = running_totals(written(counts), "score", ["pos", "neg"], descending=True, beside=beside, held=True)
    if drop_intermediate:
        points = points.where(_turns())
    points = points.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points).orderBy(F.desc_nulls_first("threshold"))


def _turns() -> Column:
    """Whether the curve may turn at a point: neither is the step to it and the one after it along the same axis.

    The first and the last point stay. So does the end of a straight stretch, whose next step goes the other way.
    """
    straight = ((F.col(f"prev_{c}").isNotNull()) & (F.col(c) == 0) & (F.col(f"next_{c}") == 0) for c in ("pos", "neg"))
    return ~F.coalesce(next(straight) | next(straight), F.lit(False))


def curve_areas(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """(roc_auc, average_precision): trapezoids over tied scores, and the step sum."""
    return _areas(score_counts(df, label, score, weight))


def _area_terms() -> tuple[Column, Column]:
    auc = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))
    ap = F.col("pos").cast("double") * F.try_divide(F.col("cum_pos").cast("double"), F.col("cum_pos") + F.col("cum_neg"))
    return auc, ap


def _areas(counts: DataFrame) -> DataFrame:
    auc, ap = _area_terms()
    return (
        running_totals(written(counts), "score", ["pos", "neg"], descending=True, held=True)
        .agg(
            F.sum(auc).alias("_auc"),
            F.sum(ap).alias("_ap"),
            F.max("all_pos").alias("_p"),
            F.max("all_neg").alias("_n"),
        )
        .select(
            F.try_divide(F.col("_auc"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"),
            F.try_divide(F.col("_ap"), F.col("_p")).alias("average_precision"),
        )
    )


def binary_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    pred: str | None = None,
    weight: str | None = None,
    cut: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """All hold-out metrics of a scored table in one row, or one row per group of ``by``.

    ``score`` is P(1). Without ``pred`` a row is predicted positive from ``cut`` up. ``mean_score``
    is the mean P(1), ``mean_confidence`` the mean probability of the likelier class.
    """
    w, y, s = _weight(weight), col_of(label), col_of(score).cast("double")
    hit = (s >= cut) if pred is None else (col_of(pred) == 1)
    zero = F.lit(0).cast("bigint") if weight is None else F.lit(0.0)

    def mass(condition: Column) -> Column:
        return F.sum(F.when(condition, w).otherwise(zero))

    keys = [col_of(c) for c in by]
    counts = (
        df.where(y.isNotNull() & s.isNotNull())
        .groupBy(*keys, s.alias("score"))
        .agg(
            mass(y == 1).alias("pos"),
            mass(y != 1).alias("neg"),
            mass((y == 1) & hit).alias("tp"),
            mass((y != 1) & hit).alias("fp"),
        )
    )
    auc, ap = _area_terms()
    n = F.col("pos") + F.col("neg")
    ranked = running_totals(written(counts), "score", ["pos", "neg"], by, descending=True, held=True)
    sums = ranked.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("pos", "neg", "tp", "fp")],
        F.sum(auc).alias("_auc"),
        F.sum(ap).alias("_ap"),
        F.sum(F.col("score") * n).alias("_score"),
        F.sum(F.greatest("score", F.lit(1.0) - F.col("score")) * n).alias("_confidence"),
    )
    counted = sums.select(
        "*", (F.col("pos") - F.col("tp")).alias("fn"), (F.col("neg") - F.col("fp")).alias("tn"), n.alias("n")
    )
    return with_class_report(counted).select(
        *keys,
        "n",
        "tn",
        "fp",
        "fn",
        "tp",
        _safe(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        F.try_divide(F.col("_auc"), F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"),
        F.try_divide(F.col("_ap"), F.col("pos")).alias("average_precision"),
        *_REPORT,
        F.try_divide(F.col("_score"), F.col("n")).alias("mean_score"),
        F.try_divide(F.col("_confidence"), F.col("n")).alias("mean_confidence"),
    )


def area_per_score(
    df: DataFrame, label: str, scores: Mapping[str, tuple[str, str]], by: str, rows: int, drawn: DataFrame | None = None
) -> DataFrame:
    """(_name, by, accuracy, roc_auc) of several scores beside each other, as :func:`binary_metrics` tells them one by one.

    ``scores`` names a column with P(1) and one with the class for each; ``by`` holds few whole numbers. Each task sorts its own
    scores, merges equal ones and hands them on in slices, so the rows are read once and not written. Slices start at
    scores of ``drawn``, a part of the rows of which :func:`draw_share` tells the size for this number of ``rows``; without it there is one.
    """
    ship(df.sparkSession)
    names = list(scores)

    def beside(rows: DataFrame) -> DataFrame:
        own = [c for i, (s, pred) in enumerate(scores.values()) for c in (col_of(s).cast("double").alias(f"s{i}"), F.coalesce(col_of(pred) == 1, F.lit(False)).alias(f"h{i}"))]
        return rows.where(col_of(label).isNotNull() & col_of(by).isNotNull()).select(col_of(by).cast("int").alias("by"), (col_of(label) == 1).alias("y"), *own)

    edges: dict[int, np.ndarray] = {}
    if drawn is not None:
        table = beside(drawn).toArrow()
        many = -(-rows // SLICE_ROWS)
        at = np.arange(1, many) / many
        for i in range(len(names)):
            found = np.sort(table.column(f"s{i}").drop_null().to_numpy())
            edges[i] = np.unique(found[(at * len(found)).astype(int)]) if len(found) else found

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        group, y = table.column("by").to_numpy(), table.column("y").to_numpy()
        out: list[tuple] = []
        for i in range(len(names)):
            known = table.column(f"s{i}").is_valid().to_numpy()
            score, hit = table.column(f"s{i}").to_numpy(), table.column(f"h{i}").to_numpy()
            for g in np.unique(group[known]):
                here = known & (group == g)
                own, truth = score[here], y[here]
                order = np.argsort(own)
                merged, pos, neg = _per_score(own[order], truth[order].astype(np.int64), (~truth[order]).astype(np.int64))
                places = np.searchsorted(edges[i], merged, side="right") if i in edges else np.zeros(len(merged), np.int64)
                starts = np.flatnonzero(np.diff(places, prepend=-1))
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(merged)])):
                    hits = (int((truth & hit[here]).sum()), int((~truth & hit[here]).sum())) if n == 0 else (0, 0)
                    out.append((i, int(g), int(places[a]), merged[a:b].tobytes(), pos[a:b].tobytes(), neg[a:b].tobytes(), *hits))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(kinds), kinds)], schema=kinds)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for b in batches:
            held.append(b)
            many += len(b)
            if many >= SORTED:
                yield cut(held)
                held, many = [], 0
        if many:
            yield cut(held)

    def merge(t: pa.Table) -> pa.Table:
        score, pos, neg = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind) for c, kind in (("score", np.float64), ("pos", np.int64), ("neg", np.int64)))
        order = np.argsort(score)
        _, pos, neg = _per_score(score[order], pos[order], neg[order])
        # By falling score, as in _area_terms.
        area = (neg[::-1].astype(float) * (np.cumsum(pos[::-1]) - pos[::-1] / 2.0)).sum()
        sums = [[int(pos.sum())], [int(neg.sum())], [sum(t.column("tp").to_pylist())], [sum(t.column("fp").to_pylist())], [float(area)]]
        return pa.table([*(t.column(c)[:1] for c in ("score_no", "by", "slice")), *sums], names=["score_no", "by", "slice", "pos", "neg", "tp", "fp", "area"])

    kinds = pa.schema(
        [("score_no", pa.int32()), ("by", pa.int32()), ("slice", pa.int32()), ("score", pa.binary()), ("pos", pa.binary()), ("neg", pa.binary()), ("tp", pa.int64()), ("fp", pa.int64())]
    )
    cuts = beside(df).mapInArrow(pieces, "score_no int, by int, slice int, score binary, pos binary, neg binary, tp long, fp long")
    slices = cuts.groupBy("score_no", "by", "slice").applyInArrow(merge, "score_no int, by int, slice int, pos long, neg long, tp long, fp long, area double")
    # A row per slice: positives of higher slices come before each of its negatives.
    higher = Window.partitionBy("score_no", "by").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("pos").over(higher), F.lit(0))
    whole = slices.withColumn("area", F.col("area") + F.col("neg").cast("double") * before).groupBy("score_no", "by")
    sums = whole.agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp", "area")])
    hits = F.col("tp") + F.col("neg") - F.col("fp")
    return sums.select(
        F.get(F.array(*[F.lit(n) for n in names]), F.col("score_no")).alias("_name"),
        F.col("by").alias(by),
        _safe(hits, F.col("pos") + F.col("neg")).alias("accuracy"),
        F.try_divide(F.col("area"), F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"),
    )


def draw_share(rows: int) -> float:
    """Share of so many rows that :func:`area_per_score` needs drawn: a fixed number for each of its slices, none for one slice."""
    return min(1.0, DRAWN * -(-rows // SLICE_ROWS) / rows) if rows > SLICE_ROWS else 0.0


def _per_score(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted scores with equal ones (also those that are not numbers) merged and their counts added."""
    new = np.ones(len(score), bool)
    new[1:] = (score[1:] != score[:-1]) & ~(np.isnan(score[1:]) & np.isnan(score[:-1]))
    starts = np.flatnonzero(new)
    return score[starts], np.add.reduceat(pos, starts), np.add.reduceat(neg, starts)


_PARTS = ("precision", "recall", "f1")
_REPORT = [
    *[f"{p}_{c}" for c in (0, 1) for p in (*_PARTS, "support")],
    *[f"{p}_{kind}" for kind in ("macro", "weighted") for p in _PARTS],
]


def with_class_report(df: DataFrame) -> DataFrame:
    """Add per-class precision, recall, F1 and support, and their averages, from tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = df.withColumns(
        {
            "precision_0": _safe(tn, tn + fn),
            "recall_0": _safe(tn, tn + fp),
            "support_0": tn + fp,
            "precision_1": _safe(tp, tp + fp),
            "recall_1": _safe(tp, tp + fn),
            "support_1": tp + fn,
        }
    )
    out = out.withColumns({f"f1_{c}": _f1(F.col(f"precision_{c}"), F.col(f"recall_{c}")) for c in (0, 1)})
    both = F.col("support_0") + F.col("support_1")
    averages = {}
    for p in _PARTS:
        a, b = F.col(f"{p}_0"), F.col(f"{p}_1")
        averages[f"{p}_macro"] = (a + b) / 2
        averages[f"{p}_weighted"] = _safe(a * F.col("support_0") + b * F.col("support_1"), both)
    return out.withColumns(averages)


def confidence(df: DataFrame, score: str = "score", name: str = "confidence") -> DataFrame:
    """Add each row's probability of its likelier class."""
    s = col_of(score)
    return df.withColumn(name, F.greatest(s, F.lit(1.0) - s))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(actual, predicted, n) in long form."""
    known = col_of(label).isNotNull() & col_of(pred).isNotNull()
    return (
        df.where(known)
        .groupBy(col_of(label).cast("int").alias("actual"), col_of(pred).cast("int").alias("predicted"))
        .agg(F.count("*").alias("n"))
    )


def f1_from_confusion(df: DataFrame, digits: int = 4) -> DataFrame:
    """Add ``f1_macro`` and ``f1_minority`` to rows holding tn, fp, fn, tp; undefined scores are 0."""
    report = with_class_report(df)
    low, high = (F.bround(F.col(f"f1_{c}"), digits) for c in (0, 1))
    return report.select(*df.columns, F.bround((low + high) / 2, digits).alias("f1_macro"), high.alias("f1_minority"))


def class_balance(df: DataFrame) -> DataFrame:
    """Class shares and weight ratio from tn, fp, fn, tp; with ``average_precision`` also its lift."""
    pos, neg = F.col("fn") + F.col("tp"), F.col("tn") + F.col("fp")
    out = df.select(
        "*",
        F.bround(_safe(neg * F.lit(100.0), pos + neg), 1).alias("majority_pct"),
        F.bround(_safe(pos * F.lit(100.0), pos + neg), 1).alias("minority_pct"),
        F.bround(_safe(neg, pos), 1).alias("minority_weight"),
    )
    if "average_precision" in df.columns:
        out = out.withColumn("ap_lift", F.try_divide(F.col("average_precision") * (pos + neg), pos))
    return out


def overfit_gap(
    train: DataFrame, test: DataFrame, label: str = "label", pred: str = "prediction"
) -> DataFrame:
    """(train_accuracy, test_accuracy, gap, warning, gap_band); the gap is in percentage points."""

    def accuracy(df: DataFrame) -> Column:
        return df.agg(F.avg(flag(col_of(label) == col_of(pred))).alias("a")).scalar()

    gap = F.col("gap")
    return (
        train.sparkSession.range(1)
        .select(accuracy(train).alias("train_accuracy"), accuracy(test).alias("test_accuracy"))
        .withColumn("gap", (F.col("train_accuracy") - F.col("test_accuracy")) * 100)
        .select(
            "*",
            flag(F.abs(gap) > GAP_WARNING).alias("warning"),
            band(gap, GAP_CUTS, GAP_NAMES).alias("gap_band"),
        )
    )


def best_threshold(
    df: DataFrame, label: str, score: str, lo: float = 0.05, hi: float = 0.95, n: int = 300
) -> DataFrame:
    """The threshold of an even grid with the highest F1 of the positives; the lowest among equals.

    Pass a validation split, not the test data. Scores are counted into the grid first, so the
    search itself sees ``n + 1`` rows.
    """
    step = (hi - lo) / (n - 1)
    s, y = col_of(score).cast("double"), col_of(label)

    def at(i: Column) -> Column:
        return F.lit(lo) + i * F.lit(step)

    near = F.floor((s - lo) / step)
    reached = F.when(s < at(near), near - 1).when(s >= at(near + 1), near + 1).otherwise(near)
    slot = F.least(F.greatest(reached, F.lit(-1)), F.lit(n - 1)).cast("int")
    counts = (
        df.where(y.isNotNull() & s.isNotNull())
        .groupBy(slot.alias("slot"))
        .agg(F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y != 1, 1)).alias("neg"))
    )
    grid = df.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("slot"))
    above = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = (
        grid.join(F.broadcast(counts), "slot", "left")
        .fillna(0)
        .select(
            "slot", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp")
        )
    )
    everyone = counts.agg(F.sum("pos").alias("p")).scalar()
    scored = swept.where("slot >= 0").select(
        at(F.col("slot")).alias("threshold"),
        _safe(F.col("tp") * 2, F.col("tp") + F.col("fp") + everyone).alias("f1"),
        _safe(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _safe(F.col("tp"), everyone).alias("recall"),
    )
    best = F.min_by(F.struct("threshold", "f1", "precision", "recall"), F.struct(-F.col("f1"), F.col("threshold")))
    return scored.agg(best.alias("b")).select("b.*")


def best_observed_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """The same over all observed scores instead of a grid."""
    ranked = running_totals(written(score_counts(df, label, score)), "score", ["pos", "neg"], descending=True, held=True)
    f1 = _safe(F.col("cum_pos") * 2, F.col("cum_pos") + F.col("cum_neg") + F.col("all_pos"))
    scored = ranked.select(F.col("score").alias("threshold"), f1.alias("f1"))
    best = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("threshold")))
    return scored.agg(best.alias("b")).select("b.*")


def baseline_metrics(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """(approach, test_accuracy) of always guessing the commonest training label, and of a coin."""
    counts = train.where(col_of(label).isNotNull()).groupBy(col_of(label).alias("_l")).agg(F.count("*").alias("n"))
    commonest = counts.agg(F.min_by("_l", F.struct(-F.col("n"), F.col("_l"))).alias("v")).scalar()
    hits = test.agg(F.avg(flag(col_of(label) == commonest)).alias("a")).scalar()
    entries = [
        F.struct(F.lit("majority_baseline").alias("approach"), hits.alias("test_accuracy")),
        F.struct(F.lit("random_baseline").alias("approach"), F.lit(0.5).alias("test_accuracy")),
    ]
    return test.sparkSession.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def capture_at(df: DataFrame, label: str, score: str, fraction: float = 0.2) -> DataFrame:
    """Share of the positives among the top-scored fraction of rows, and its lift over chance.

    The cut is the score of the last row inside the fraction; rows tied with it are all included.
    """
    counts = score_counts(df, label, score)
    n = F.col("pos") + F.col("neg")
    total = F.col("all_pos") + F.col("all_neg")
    k = F.floor(total * F.lit(fraction))
    ranked = running_totals(written(counts), "score", ["pos", "neg"], descending=True, held=True)
    seen = F.col("cum_pos") + F.col("cum_neg")
    inside = seen - n < k
    return (
        ranked.agg(
            F.min(F.when(inside, F.col("score"))).alias("cut_score"),
            F.coalesce(F.sum(F.when(inside, n)), F.lit(0)).alias("rows_selected"),
            F.coalesce(F.sum(F.when(inside, F.col("pos"))), F.lit(0)).alias("positives_selected"),
            F.max("all_pos").alias("positives"),
            F.max(total).alias("rows"),
        )
        .withColumn("captured", F.try_divide(F.col("positives_selected").cast("double"), F.col("positives")))
        .withColumn(
            "lift", F.try_divide(F.col("captured") * F.col("rows"), F.col("rows_selected").cast("double"))
        )
    )
