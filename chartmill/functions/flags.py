"""0/1 indicator expressions. A flag is an int and never null: an unknown comparison counts as 0."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}


def col_of(c: str | Column) -> Column:
    """Column by exact name, so that hyphens, dots and spaces are safe."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def equals(c: str | Column, value) -> Column:
    return flag(col_of(c) == F.lit(value))


def threshold(c: str | Column, op: str, value) -> Column:
    return flag(_COMPARE[op](col_of(c), F.lit(value)))


def in_set(c: str | Column, values: Iterable) -> Column:
    return flag(col_of(c).isin(*values))


def all_of(*conditions: Column) -> Column:
    return flag(reduce(operator.and_, conditions))


def any_of(*conditions: Column) -> Column:
    """1 when some condition holds, also beside unknown ones."""
    return F.greatest(*[flag(c) for c in conditions]) if len(conditions) > 1 else flag(conditions[0])


def count_where(cols: Sequence[str | Column], predicate: Callable[[Column], Column]) -> Column:
    """How many of the columns satisfy the predicate, per row."""
    return reduce(operator.add, [flag(predicate(col_of(c))) for c in cols])


def one_hot(c: str | Column, levels: Sequence, prefix: str) -> list[Column]:
    """One named indicator per level, in the order given."""
    return [equals(c, v).alias(f"{prefix}{str(v).lower()}") for v in levels]
