"""URL filters: rules by host and path, and a weighted vocabulary searched by Aho-Corasick.

**Rules.** A rule ``host/path`` fits its host and all subdomains where the URL's path starts with the rule's; the longest
one that fits decides.

**Vocabulary.** Where no rule fits, one automaton of all terms goes through the URL behind ``://``, letters A-Z
lower-cased and escapes such as ``%20`` read as a gap. A hit counts where no letter a-z and no digit stands right before or
after it. One strict term rejects the URL; soft terms do when several *different* ones hit. The walk is linear in the URL,
whatever the number of terms.

A row is judged on its own: rules and terms (arguments, so bounded) travel with the tasks, rows never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.llm.common import map_arrow

#: Terms that alone reject a URL, and terms of which several different ones do.
STRICT = (
    "adult", "camgirls", "casino", "casinos", "cialis", "escorts", "hentai", "milf", "nsfw", "nude", "nudes", "onlyfans",
    "porn", "porno", "pornos", "sexcam", "sexcams", "slotmachine", "viagra", "warez", "xxx",
)
SOFT = (
    "ads", "affiliate", "bet", "bets", "betting", "bonus", "cams", "cheap", "coupon", "coupons", "crack", "cracked", "dating",
    "deals", "discount", "farm", "free", "gambling", "girls", "jackpot", "keygen", "linkfarm", "loan", "loans", "lottery",
    "payday", "pharmacy", "pill", "pills", "poker", "popup", "replica", "seo", "sex", "sexy", "singles", "slots", "spam",
    "torrent", "track", "tracker", "tracking", "win", "winner",
)
#: Different soft terms that reject a URL.
SOFT_LIMIT = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ESCAPE = re.compile("%[0-9a-f][0-9a-f]")
_LETTERS = frozenset(LOWER + "0123456789")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_behind(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_behind(url), r"^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


class Rules:
    """``rules`` as (verdict, "host/path"), looked up by the host's endings."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            if verdict not in ("allow", "block") or not slash:
                raise ValueError(f"not a rule: {verdict} {rule}")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        self.most = max((h.count(".") for h in self.by_host), default=0)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest one that fits; of equally long ones, that of the longer host."""
        # Only as many labels from the end as the longest rule's host has.
        labels = host.rsplit(".", self.most + 1)
        ends = [host] if len(labels) <= self.most + 1 else []
        ends += [".".join(labels[i:]) for i in range(1, len(labels))]
        fits = [
            (len(rule), len(end), rule, verdict)
            for end in ends
            for start, rule, verdict in self.by_host.get(end, ())
            if path.startswith(start)
        ]
        return max(fits)[2:] if fits else None


class Vocabulary:
    """An automaton of strict and soft terms."""

    def __init__(self, strict: Iterable[str], soft: Iterable[str]):
        self.automaton = ahocorasick.Automaton()
        for strong, terms in ((False, soft), (True, strict)):
            for term in terms:
                self.automaton.add_word(term, (term, strong))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[int, int]:
        """How many different strict and soft terms stand alone in what follows ``://``."""
        _, _, text = url.partition("://")
        if not text or not len(self.automaton):
            return 0, 0
        text = _ESCAPE.sub(" ", text.translate(_FOLD))
        found = set()
        for end, (term, strong) in self.automaton.iter(text):
            before, after = end - len(term), end + 1
            if (before < 0 or text[before] not in _LETTERS) and (after == len(text) or text[after] not in _LETTERS):
                found.add((term, strong))
        strict = sum(strong for _, strong in found)
        return strict, len(found) - strict


_FOLD = str.maketrans(UPPER, LOWER)


def judge_urls(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    url: str = "url",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``carry`` (default: all) of every row, with ``host``, ``path``, ``rule`` (null: none fits),
    ``strict_hits``, ``soft_hits`` (different terms, whether or not a rule fits) and ``verdict`` (allow or block); they
    replace columns of these names. Terms are given in lower case; a term given as strict and soft is strict.

    A null or empty URL, or one without ``://``, has an empty host and path and no hits, and is allowed. URLs of any
    length are read whole. Repeated rows are judged each; an empty table stays empty.
    """
    added = {"host": "", "path": "", "rule": "", "strict_hits": 0, "soft_hits": 0, "verdict": ""}
    carried = [c for c in (carry if carry is not None else df.columns) if c not in added]
    known, terms = list(rules), (list(strict), list(soft))
    Rules(known)  # wrong ones fail here

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        listed, vocabulary = Rules(known), Vocabulary(*terms)
        for b in batches:
            urls, hosts, paths = (b.column(len(carried) + i).to_pylist() for i in range(3))
            found = [listed.find(h, p) for h, p in zip(hosts, paths)]
            hits = [vocabulary.hits(u or "") for u in urls]
            verdict = [
                f[1] if f else "block" if n or m >= soft_limit else "allow" for f, (n, m) in zip(found, hits)
            ]
            yield [
                *b.columns[: len(carried)],
                b.column(len(carried) + 1),
                b.column(len(carried) + 2),
                pa.array([f and f[0] for f in found], pa.string()),
                pa.array([n for n, _ in hits], pa.int32()),
                pa.array([m for _, m in hits], pa.int32()),
                pa.array(verdict, pa.string()),
            ]

    address = F.col(f"`{url}`").cast("string")
    kinds = {c: T.IntegerType() if v == 0 else T.StringType() for c, v in added.items()}
    inputs = [address, F.coalesce(host_of(address), F.lit("")), F.coalesce(path_of(address), F.lit(""))]
    return map_arrow(df, carried, inputs, run, kinds)
