"""Quality scores by co-training two views of a document.

The **content** view sees what the words of the whole text look like: shares of word shapes (letters, capitals,
digits, signs), repetition, length of words. The **metadata** view sees what stands beside the text: source, language,
the stated length, and the layout (lines, bytes a character). Each view has a classifier of its own. Over rounds,
each labels the documents of an unlabelled pool of which it is most sure, and the other learns from them as well. At
the end the views' scores are calibrated on labelled documents that neither has learnt from, combined, and applied
to all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import map_arrow, ship
from chartmill.llm.logistic import MOST_LABELLED, class_weights, fit, held_out, labelled, sigmoid

#: Most unlabelled documents in the pool (in expectation of a random sample).
POOL = 6_000
ROUNDS = 5
#: How sure a view must be, and the most pseudo-labels of a class that it gives in a round.
SURE, GIVEN = 0.95, 200

_SHAPE = bytes.maketrans(
    bytes(range(256)),
    bytes(
        97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\v\f\r" else b
        for b in range(256)
    ),
)
_RUN = re.compile(rb"(.)\1+")
#: Shapes with a feature of their own, after runs of one sign become one; all others share one.
SHAPES = (b"a", b"Aa", b"A", b"0", b"a,", b"a.", b"A,", b"A.", b"Aa.", b"|", b"a|", b"a#", b"a*", b"a$", b"a%", b"a&", b"A!", b"A.!", b"Aa*", b"#", b"*", b"<", b">")
SOURCES, LANGS = 32, 8


def content(text: str) -> list[float]:
    """The content view of a whole text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    shapes = Counter(_RUN.sub(rb"\1", data.translate(_SHAPE)).split())
    known = [shapes.get(s, 0) / max(n, 1) for s in SHAPES]
    signs = sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!"))) / max(n, 1)
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    return [
        *known,
        1 - sum(known) if n else 0.0,
        min(signs, 3.0),
        len(set(words)) / n if n else 1.0,
        pairs if n > 1 else 1.0,
        min(len(data) / max(n, 1), 30.0) / 10,
        float(n < 5),
        1.0 / (1 + n / 20),
    ]


def metadata(source: str | None, lang: str | None, n_chars: float | None, text: str) -> list[float]:
    """The metadata view: one of 32 + 8 hashed places for source and language, lengths, layout."""
    one = [0.0] * (SOURCES + LANGS)
    for value, low, size in ((source, 0, SOURCES), (lang, SOURCES, LANGS)):
        if value is not None:
            one[low + zlib.crc32(str(value).encode()) % size] = 1.0
    stated = float(n_chars) if n_chars is not None and n_chars == n_chars else 0.0
    lines = text.count("\n") + 1
    per_line = len(text) / lines
    return [
        *one,
        float(n_chars is None),
        np.log1p(max(stated, 0.0)) / 10,
        np.log1p(lines) / 5,
        np.log1p(per_line) / 5,
        (np.log1p(per_line) / 5) ** 2,
        len(text.encode()) / max(len(text), 1) - 1,
        float(bool(text) and abs(stated - len(text)) > 0.5),
    ]


@dataclass
class View:
    """Standardised features, weights, and (after calibration) scores whose odds are right."""

    middle: np.ndarray
    spread: np.ndarray
    w: np.ndarray
    b: float

    @staticmethod
    def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
        middle, spread = x.mean(axis=0), x.std(axis=0)
        spread = np.where(spread > 1e-9, spread, 1.0)
        w, b = fit((x - middle) / spread, y, weight, l2=1e-3)
        return View(middle, spread, w, b)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.middle) / self.spread) @ self.w + self.b, -30, 30)


@dataclass
class CoTrained:
    views: list[View]
    calibration: list[tuple[np.ndarray, float]]  # of each view's odds
    mix: tuple[np.ndarray, float]  # of the calibrated odds
    given: list[tuple[int, int]]  # pseudo-labels that the views gave, by round

    def score(self, xs: list[np.ndarray]) -> np.ndarray:
        calibrated = [v.odds(x) * a[0] + b for v, x, (a, b) in zip(self.views, xs, self.calibration)]
        return sigmoid(np.clip(np.stack(calibrated, axis=1), -10, 10) @ self.mix[0] + self.mix[1])


def co_train(
    xs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, pool: list[np.ndarray], calibrate: np.ndarray,
    rounds: int = ROUNDS, sure: float = SURE, most: int = GIVEN,
) -> CoTrained:
    """Two views of labelled rows, of pool rows, and which labelled rows calibrate (and are not learnt from).

    In a round, each view labels the pool rows of either class of which it is at least ``sure``, at most ``most`` of
    each, the surest first, in proportion to the classes; a row that both label differently is left out. The other
    view learns from them at the mean weight of its own rows.
    """
    own = ~calibrate
    share = np.average(y, weights=weight)
    extra = [(np.zeros(0, int), np.zeros(0, int)) for _ in xs]  # pool rows and labels that a view is given
    free, given = np.ones(len(pool[0]), bool), []
    views: list[View] = []
    for turn in range(rounds + 1):
        views = [
            View.fitted(
                np.concatenate([x[own], p[rows]]),
                np.concatenate([y[own], labels]),
                np.concatenate([weight[own], np.full(len(rows), weight[own].mean())]),
            )
            for x, p, (rows, labels) in zip(xs, pool, extra)
        ]
        if turn == rounds or not free.any():
            break
        found: list[dict[int, int]] = []
        for v, p in zip(views, pool):
            s = sigmoid(v.odds(p))
            named: dict[int, int] = {}
            for label, sureness, part in ((1, s, share), (0, 1 - s, 1 - share)):
                at = np.flatnonzero(free & (sureness >= sure))
                at = at[np.argsort(-sureness[at], kind="stable")][: max(1, round(most * part))]
                named |= dict.fromkeys(at.tolist(), label)
            found.append(named)
        given.append((len(found[0]), len(found[1])))
        for mine, other in ((0, 1), (1, 0)):
            good = {r: k for r, k in found[other].items() if found[mine].get(r, k) == k}
            rows, labels = np.array(list(good), int), np.array(list(good.values()), int)
            extra[mine] = (np.append(extra[mine][0], rows), np.append(extra[mine][1], labels))
        for named in found:
            free[list(named)] = False
        if not any(found):
            break
    some = calibrate if calibrate.any() and 0 < y[calibrate].mean() < 1 else np.ones(len(y), bool)
    odds = [v.odds(x[some])[:, None] for v, x in zip(views, xs)]
    calibration = [fit(o, y[some], weight[some], l2=1e-2) for o in odds]
    both = np.concatenate([o * a + b for o, (a, b) in zip(odds, calibration)], axis=1)
    return CoTrained(views, calibration, fit(np.clip(both, -10, 10), y[some], weight[some], l2=1e-2), given)


_NUMBERS = "content array<double>, meta array<double>"


def _views_of(batch: pa.RecordBatch, at: int) -> tuple[list[list[float]], list[list[float]]]:
    columns = [batch.column(at + i).to_pylist() for i in range(4)]
    return [content(t or "") for t in columns[0]], [metadata(s, lang, n, t or "") for t, s, lang, n in zip(*columns)]


def _inputs(df: DataFrame, text: str, source: str, lang: str, n_chars: str) -> list:
    def column(name: str, kind: str):
        return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)

    return [column(text, "string").alias("_t"), column(source, "string").alias("_s"), column(lang, "string").alias("_l"), column(n_chars, "double").alias("_n")]


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    most: int = MOST_LABELLED,
    pool: int = POOL,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
) -> CoTrained | float:
    """Learn from at most ``most`` labelled documents of each class outside the held-out fifth, and a random pool of about
    ``pool`` others; all read whole. The driver receives their numbers, no texts. A quarter of the labelled calibrates.
    Without labels of both classes: the share of good labels (none: 0), as a constant score.
    """
    ship(docs.sparkSession)
    needed = list(dict.fromkeys(c for c in (text, source, lang, n_chars) if c in docs.columns))
    rows, sizes = labelled(docs, labels, label, needed, most, doc_id)
    if not sizes.get(0) or not sizes.get(1):
        return float(bool(sizes.get(1)))

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _views_of(batch, 2)
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, kind), pa.array(b, kind)], names=["y", "k", "content", "meta"])

    schema = f"y int, k long, {_NUMBERS}"
    fold = F.crc32(F.concat(F.lit("calibrate:"), F.col("id").cast("string")).cast("binary")) % 4
    got = rows.select("y", fold.alias("k"), *_inputs(rows, text, source, lang, n_chars)).mapInArrow(numbers, schema).orderBy("k", "y", "content", "meta").collect()
    if len({r["y"] for r in got}) < 2:
        return float(np.mean([r["y"] for r in got])) if got else 0.0
    n = docs.count()
    others = docs.sample(fraction=min(1.0, pool / max(n, 1)), seed=23)
    free = others.select(F.lit(0).alias("y"), F.lit(0).cast("long").alias("k"), *_inputs(docs, text, source, lang, n_chars))
    unseen = free.mapInArrow(numbers, schema).orderBy("content", "meta").collect()
    y = np.array([r["y"] for r in got])
    views = [np.array([r[c] for r in got]) for c in ("content", "meta")]
    pooled = [np.array([r[c] for r in unseen]).reshape(len(unseen), views[i].shape[1]) for i, c in enumerate(("content", "meta"))]
    return co_train(views, y, class_weights(y, sizes), pooled, np.array([r["k"] == 0 for r in got]))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher: better), ``predicted`` (1 if score >= 0.5, else 0) and ``kept``
    (the same as boolean) of every document, texts read whole.

    Nulls in any column are allowed (a null or empty text has no words) and a missing metadata column counts as null.
    Repeated rows are scored each; an empty table stays empty. Training as in :func:`train`.
    """
    model = train(docs, labels, doc_id=doc_id, text=text, source=source, lang=lang, n_chars=n_chars)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            if isinstance(model, float):
                scores = np.full(len(batch), model)
            else:
                views = _views_of(batch, 1)
                scores = model.score([np.array(v) for v in views]) if len(batch) else np.zeros(0)
            yield [batch.column(0), pa.array(scores, pa.float64())]

    scored = map_arrow(docs, [doc_id], _inputs(docs, text, source, lang, n_chars), run, {"score": T.DoubleType()})
    good = F.col("score") >= 0.5
    return scored.select(F.col(f"`{doc_id}`"), held_out(doc_id).alias("held_out"), "score", good.cast("int").alias("predicted"), good.alias("kept"))
