"""Numeric expressions."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartmill.functions.flags import col_of


# A decimal number or infinity. SQL casts also take type letters and hexadecimal, which are no numbers here.
_NUMERIC_TEXT = r"^\s*[+-]?([0-9.][0-9.eE+-]*|(?i:inf|infinity))\s*$"


def to_number(c: str | Column, kind: str = "double", default=None) -> Column:
    """Numeric value of a text; text that is no number, and text ``NaN``, becomes null or ``default``."""
    text = col_of(c).cast("string")
    value = F.when(text.rlike(_NUMERIC_TEXT), text).try_cast("double")
    if kind != "double":
        value = value.try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Sum across columns; one null makes the sum null."""
    return reduce(operator.add, [col_of(c) for c in cols])


def ratio(num: str | Column, den: str | Column, offset: int = 1) -> Column:
    """``num / (den + offset)``; null where the denominator is 0."""
    return F.try_divide(col_of(num).cast("double"), col_of(den) + F.lit(offset))


def log1p(c: str | Column) -> Column:
    return F.log1p(col_of(c))


def percent(c: str | Column, digits: int = 1) -> Column:
    """Share as a percentage, rounded half to even."""
    return F.bround(col_of(c) * F.lit(100.0), digits)


def band(c: str | Column, cuts: Sequence[float], labels: Sequence[str], inclusive: bool = True) -> Column:
    """Label of the highest cut reached. ``cuts`` fall; ``labels`` has one more entry, for the rest.

    A null value has no band. With ``inclusive=False`` a cut must be exceeded.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cuts")
    source = col_of(c)
    out = F.lit(labels[-1])
    for cut, label in reversed(list(zip(cuts, labels))):
        cut = cut if isinstance(cut, Column) else F.lit(cut)
        hit = source >= cut if inclusive else source > cut
        out = F.when(hit, F.lit(label)).otherwise(out)
    return F.when(source.isNotNull(), out)


def label_case(
    c: str | Column, positive: str = "Early Readmission Risk", negative: str = "Low Readmission Risk"
) -> Column:
    """Reader text of a 0/1 prediction."""
    return F.when(col_of(c) == 1, F.lit(positive)).otherwise(F.lit(negative))
