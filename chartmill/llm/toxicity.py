"""Toxicity scores from a classifier with a counterfactual penalty.

A logistic regression over the words of a text and their beginnings (each counted once) learns from labelled
documents. Sentences of these that name a group of people are said again with another group of the same kind and with
none; differences in score between the two are penalised in training. So the model cannot learn that the mention of
a group is toxic because toxic texts mention it more often, and neutral mentions are not held against a text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import map_arrow, ship
from chartmill.llm.logistic import MOST_LABELLED, Sparse, class_weights, fit, held_out, labelled, sigmoid

#: Names of groups of people, by kind: swapped within a kind.
IDENTITIES = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("mexican", "chinese", "indian", "american", "german", "french", "spanish", "russian", "turkish", "polish"),
    ("immigrants", "refugees", "foreigners", "migrants", "locals", "natives"),
    ("immigrant", "refugee", "foreigner", "migrant", "local", "native"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("deaf", "blind", "disabled", "autistic", "paralyzed"),
    ("old", "elderly", "young", "teenage", "middle-aged"),
    ("femmes", "hommes", "frauen", "männer", "mujeres", "hombres"),
    ("musulmans", "chrétiens", "juifs", "muslime", "christen", "juden", "musulmanes", "cristianos", "judíos"),
)

#: Most features, and least documents with a feature.
FEATURES = 4_096
LEAST_DOCUMENTS = 5
#: Least standard errors between the classes for a feature.
LEAST_GAP = 3.5
MEMO = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_KIND = {w: kind for kind in IDENTITIES for w in kind}


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(word: str) -> list[str]:
    """A word, and its beginnings of four to seven letters (marked by a hyphen)."""
    return [word, *[word[:n] + "-" for n in range(4, min(len(word), 8))]]


def counterfactuals(text: str) -> list[tuple[str, str]]:
    """(sentence, the same with its group names swapped) of all sentences that name groups: once each for the next
    name of its kind and for none."""
    found = []
    for s in _SENTENCE.findall(text.lower()):
        if any(w in _KIND for w in _WORD.findall(s)):
            found.append((s, _WORD.sub(lambda m: _next(m.group()), s)))
            found.append((s, _WORD.sub(lambda m: "" if m.group() in _KIND else m.group(), s)))
    return found


def _next(word: str) -> str:
    kind = _KIND.get(word)
    return kind[(kind.index(word) + 1) % len(kind)] if kind else word


class Model:
    """Weights of chosen features, and the intercept."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.memo: dict[str, tuple[str, ...]] = {}

    def _known(self, word: str) -> tuple[str, ...]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            found = self.memo[word] = tuple(f for f in features(word) if f in self.weights)
        return found

    def present(self, text: str) -> set[str]:
        return set().union(*map(self._known, words(text)))

    def score(self, text: str) -> float:
        return float(sigmoid(np.array(self.intercept + math.fsum(map(self.weights.__getitem__, self.present(text))))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    even: float = 10.0,
    most: int = MOST_LABELLED,
    n_features: int = FEATURES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """Fit on at most ``most`` labelled documents of each class outside the held-out fifth, read whole.

    ``even`` weighs the counterfactual penalty (0: none). Features are those of at least five documents that tell the
    classes apart best, at most ``n_features``. Only their numbers, and of pairs only the differences, reach the driver.
    All sentences that name groups count in the penalty; a document's pairs weigh one together, and equal differences
    in it are sent once. Without labels of both classes the score is the share of toxic labels (none: 0).
    """
    ship(docs.sparkSession)
    rows, sizes = labelled(docs, labels, label, [text], most, doc_id)
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, 40.0 if sizes.get(1) else -40.0)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1)):
                own = list({f for w in words(t.as_py() or "") for f in features(w)})
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([y.as_py()] * len(own), pa.int32())], names=["f", "y"])

    sides = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = max(sides.get(0, 0), 1), max(sides.get(1, 0), 1)
    texts = rows.select(F.col(f"`{text}`").cast("string").alias("t"), "y")
    share = (F.col("n") + 1) / (n0 + n1 + 2)
    # How far the classes' shares lie apart, in standard errors.
    gap = F.abs(F.col("n1") / n1 - (F.col("n") - F.col("n1")) / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    chosen = (
        texts.mapInArrow(emit, "f string, y int")
        .groupBy("f")
        .agg(F.count("*").alias("n"), F.sum("y").alias("n1"))
        .where((F.col("n") >= LEAST_DOCUMENTS) & (gap >= LEAST_GAP))
        .orderBy(gap.desc(), "f")
        .limit(n_features)
        .collect()
    )
    place = {r["f"]: i for i, r in enumerate(chosen)}
    empty = Model(dict.fromkeys(place, 0.0), 0.0)

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1)):
                t = t.as_py() or ""
                diffs = Counter()
                for one, other in counterfactuals(t):
                    a, b = empty.present(one), empty.present(other)
                    diffs[tuple(sorted([place[f] + 1 for f in a - b] + [-place[f] - 1 for f in b - a]))] += 1
                n = sum(diffs.values())
                yield pa.RecordBatch.from_arrays(
                    [
                        y_array(y.as_py()),
                        pa.array([[place[f] for f in empty.present(t)]], pa.list_(pa.int32())),
                        pa.array([[*diffs]], pa.list_(pa.list_(pa.int32()))),
                        pa.array([[k / n for k in diffs.values()]], pa.list_(pa.float64())),
                    ],
                    names=["y", "at", "diffs", "parts"],
                )

    def y_array(y: int) -> pa.Array:
        return pa.array([y], pa.int32())

    got = texts.mapInArrow(numbers, "y int, at array<int>, diffs array<array<int>>, parts array<double>").collect()
    if not got:
        return Model({}, -40.0)
    y = np.array([r["y"] for r in got])
    diffs = [(d, part) for r in got for d, part in zip(r["diffs"], r["parts"]) if d]
    # The penalty is a mean of squares over the pairs: roots of their weights go into the differences.
    scale = len(diffs) / (sum(part for _, part in diffs) or 1.0)
    values = [[math.copysign(math.sqrt(part * scale), c) for c in d] for d, part in diffs]
    pairs = Sparse([[abs(c) - 1 for c in d] for d, _ in diffs], len(place), values)
    w, b = fit(Sparse([r["at"] for r in got], len(place)), y, class_weights(y, sizes), pairs=pairs, even=even)
    return Model({f: float(w[i]) for f, i in place.items()}, b)


def score_documents(df: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all, if not given) and ``score``, 0 to 1, of each whole text; null and empty texts have that of
    no words. An existing column ``score`` is replaced. Repeated rows are scored each; an empty table stays empty."""
    rest = [c for c in (df.columns if carry is None else carry) if c != "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            scores = [model.score(t.as_py() or "") for t in batch.column(len(rest))]
            yield [*batch.columns[: len(rest)], pa.array(scores, pa.float64())]

    return map_arrow(df, rest, [F.col(f"`{text}`").cast("string")], run, {"score": T.DoubleType()})


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document; training as in :func:`train`."""
    scored = score_documents(docs, train(docs, labels, doc_id=doc_id, text=text), text, [doc_id])
    return scored.select(
        F.col(f"`{doc_id}`"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
