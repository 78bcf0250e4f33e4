"""Quality rules as a short-circuit cascade.

A rule looks at one whole document and says whether it rejects it. On a sample, each rule's cost (seconds a
document) and selectivity (share of documents it rejects) are measured; the cascade then asks the rules in
descending order of rejection per cost and stops at the first that rejects. A document is kept when no rule
rejects it, so the order decides the cost alone, never the verdict: the sample may be small, and a rerun that
measures other seconds gives the same rows.

Rules share what they have in common (words, lines, counts) through :class:`Document`, which computes each
such value at most once, and only when a rule or a caller asks for it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import map_arrow, ship, text_bytes

SYMBOLS = re.compile(rb"[#*$%&|<>]")
LETTERS = re.compile(r"[^\W\d_]")


class Document:
    """A whole text (UTF-8) with its measures, each computed when first asked for."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that have a word."""
        return [x for x in self.data.split(b"\n") if x and not x.isspace()]

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.data))

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines equal to an earlier one."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a three-word window that the text has twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(windows) == len(set(windows)):
            return 0
        often = {x for x, n in Counter(windows).items() if n > 1}
        total, covered = 0, 0  # covered: words before this position are counted
        for i, x in enumerate(windows):
            if x in often:
                total += i + 3 - max(i, covered)
                covered = i + 3
        return total

    @cached_property
    def letters(self) -> tuple[int, int]:
        """Letters, and capitals among them."""
        text = self.data.decode()
        return len(LETTERS.findall(text)), sum(map(str.isupper, text))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


#: The base rules: too short, or mostly repetition.
BASE = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
#: What else marks junk: symbols in the place of words, shouting, lines over and over, no words of usual length.
FURTHER = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("capitals", lambda d: 2 * d.letters[1] > d.letters[0]),
    Rule("repeated_lines", lambda d: 2 * d.n_dup_lines > len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
)
RULES = BASE + FURTHER


@dataclass(frozen=True)
class Estimate:
    """What the sample says of one rule."""

    rule: str
    documents: int
    rejected: int
    seconds: float

    @property
    def gain(self) -> float:
        """Rejections per second; without any, cheaper rules are worth more."""
        return (self.rejected + 1e-3) / max(self.seconds, 1e-9)


def estimate(df: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = 1000) -> list[Estimate]:
    """Measure each rule alone on a random sample of about ``rows`` documents, in the tasks that read them.

    The driver receives one small row per rule. An empty table gives zero counts.
    """
    ship(df.sparkSession)
    n = df.count()
    sample = df.select(text_bytes(text).alias("t")).sample(fraction=min(1.0, rows / max(n, 1)), seed=17)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, rule in enumerate(rules):
                rejected, start = 0, time.perf_counter()
                for t in texts:
                    rejected += bool(rule.rejects(Document(t)))
                spent = time.perf_counter() - start
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([len(texts)]), pa.array([rejected]), pa.array([spent])],
                    names=["rule", "documents", "rejected", "seconds"],
                )

    found = {
        r["rule"]: r
        for r in sample.mapInArrow(measure, "rule int, documents long, rejected long, seconds double")
        .groupBy("rule")
        .agg(F.sum("documents").alias("documents"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))
        .collect()
    }
    return [
        Estimate(rule.name, found[i]["documents"], found[i]["rejected"], found[i]["seconds"])
        if i in found
        else Estimate(rule.name, 0, 0, 0.0)
        for i, rule in enumerate(rules)
    ]


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """The rules by descending rejection per cost; ties by name."""
    by_name = {e.rule: e for e in estimates}
    return sorted(rules, key=lambda r: (-by_name[r.name].gain, r.name))


def cascade(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    measures: Sequence[str] = (),
    flags: dict[str, Sequence[Rule]] | None = None,
    sample_rows: int = 1000,
    kept: str = "kept",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``df`` (of the columns, those in ``carry`` if given), plus ``kept``: true where no rule rejects the document.

    ``measures`` adds counts of :class:`Document` under their names, ``flags`` booleans that are true where any
    rule of a group rejects; what a measure has counted for a row, the rules use again. Added columns replace
    columns of the same name. A null text is an empty one; repeated rows and ties are judged one by one; an empty
    table stays empty. Texts are read whole. Work is one pass over the rows, after one over the sample.
    """
    plan = ordered(rules, estimate(df, rules, text, sample_rows))
    groups = dict(flags or {})
    kinds = {m: T.LongType() for m in measures} | {g: T.BooleanType() for g in [*groups, kept]}
    rest = [c for c in (df.columns if carry is None else carry) if c not in kinds]
    at = rest.index(text) if text in rest else len(rest)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in kinds}
            for t in batch.column(at).cast(pa.binary()):
                d = Document(t.as_py() or b"")
                for m in measures:
                    columns[m].append(getattr(d, m))
                for g, members in groups.items():
                    columns[g].append(any(r.rejects(d) for r in members))
                columns[kept].append(not any(r.rejects(d) for r in plan))
            yield [
                *batch.columns[: len(rest)],
                *[pa.array(v, pa.int64() if c in measures else pa.bool_()) for c, v in columns.items()],
            ]

    return map_arrow(df, rest, [] if text in rest else [F.col(f"`{text}`")], judge, kinds)
