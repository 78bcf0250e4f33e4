"""Text canonicalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartmill.functions.flags import col_of


# What the reference's strip takes for whitespace.
WHITESPACE = "".join(
    [" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028\u2029\u202f\u205f\u3000"]
)


def strip(c: str | Column) -> Column:
    """Remove all surrounding whitespace; plain trim would leave tabs and line ends."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def canonical(
    c: str | Column, case: str | None = None, trim: bool = False, null_text: str | None = None
) -> Column:
    """Change case and optionally trim. ``null_text`` turns nulls into that text first."""
    out = col_of(c)
    if null_text is not None:
        out = F.coalesce(out, F.lit(null_text))
    if trim:
        out = strip(out)
    if case == "upper":
        return F.upper(out)
    if case == "lower":
        return F.lower(out)
    if case is not None:
        raise ValueError(f"unknown case {case!r}")
    return out


def nullify(c: str | Column, tokens: Iterable[str]) -> Column:
    """Null for text that equals one of the tokens."""
    tokens = list(tokens)
    out = col_of(c)
    return F.when(~out.isin(*tokens), out) if tokens else out
