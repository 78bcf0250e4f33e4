"""Recoding of categories and code systems."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartmill.functions.flags import col_of
from chartmill.functions.text import strip

#: ``default=KEEP`` leaves unmapped values as they are.
KEEP = object()

# Disease categories in code order, each with its half-open ICD-9 range
# and, where there is one, the single symptom code that also belongs to it.
ICD9_RANGES = [
    ("Diabetes", 250, 251, None),
    ("Circulatory", 390, 460, 785),
    ("Respiratory", 460, 520, 786),
    ("Digestive", 520, 580, 787),
    ("Genitourinary", 580, 630, 788),
    ("Musculoskeletal", 710, 740, None),
    ("Injury", 800, 1000, None),
    ("Neoplasms", 140, 240, None),
]
ICD9_CATEGORIES = [name for name, *_ in ICD9_RANGES] + ["Other"]

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def recode(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Look values up in a mapping.

    Unmapped values (and nulls) become ``default``: ``KEEP`` keeps them, ``None`` nulls them,
    anything else replaces them.
    """
    source = col_of(c)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), source)
    if default is None:
        return found
    return F.coalesce(found, source if default is KEEP else F.lit(default))


def band_midpoint(c: str | Column) -> Column:
    """``'[60-70)'`` -> 65.0; text of another form -> null."""
    source = col_of(c)
    form = r"^\[(\d+)-(\d+)\)$"
    bound = [F.regexp_extract(source, form, i).try_cast("double") for i in (1, 2)]
    return F.when(source.rlike(form), (bound[0] + bound[1]) / F.lit(2.0))


def midpoint_band(c: str | Column, width: int = 10, low: int = 0, high: int = 100) -> Column:
    """65.0 -> ``'[60-70)'``; a number that is not a band's midpoint -> null."""
    names = {a + width / 2: f"[{a}-{a + width})" for a in range(low, high, width)}
    return recode(col_of(c).cast("double"), names)


def icd9_category(c: str | Column) -> Column:
    """Disease category of an ICD-9 code; anything that is no plain number is ``Other``."""
    code = strip(c)
    number = F.when(code.rlike(_NUMBER), code.try_cast("double"))

    def category(v: Column) -> Column:
        out = F.lit("Other")
        for name, low, high, symptom in reversed(ICD9_RANGES):
            hit = (v >= low) & (v < high)
            if symptom is not None:
                hit = hit | (v == symptom)
            out = F.when(hit, F.lit(name)).otherwise(out)
        return out

    # Bound once: spelled out in every comparison, the number would be parsed again for each.
    return F.get(F.transform(F.array(number), category), F.lit(0))


def position_code(c: str | Column, levels: Sequence, default: int | None = None) -> Column:
    """Position of the value in an ordered list of levels."""
    return recode(c, {level: i for i, level in enumerate(levels)}, default)


def group_codes(c: str | Column, groups: Mapping[int, Iterable], default: int) -> Column:
    """``{group: codes}`` -> group of the code; all other codes and null -> ``default``."""
    source = col_of(c)
    out = None
    for group, codes in groups.items():
        hit = source.isin(*codes)
        out = F.when(hit, F.lit(group)) if out is None else out.when(hit, F.lit(group))
    return out.otherwise(F.lit(default))
