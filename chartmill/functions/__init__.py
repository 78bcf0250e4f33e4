"""Column expressions; everything here stays inside Catalyst."""

from chartmill.functions.codes import (
    ICD9_CATEGORIES,
    KEEP,
    band_midpoint,
    group_codes,
    icd9_category,
    midpoint_band,
    position_code,
    recode,
)
from chartmill.functions.flags import (
    all_of,
    any_of,
    col_of,
    count_where,
    equals,
    flag,
    in_set,
    one_hot,
    threshold,
)
from chartmill.functions.numbers import band, label_case, log1p, percent, ratio, row_sum, to_number
from chartmill.functions.text import canonical, nullify, strip

__all__ = [
    "ICD9_CATEGORIES",
    "KEEP",
    "all_of",
    "any_of",
    "band",
    "band_midpoint",
    "canonical",
    "col_of",
    "count_where",
    "equals",
    "flag",
    "group_codes",
    "icd9_category",
    "in_set",
    "label_case",
    "log1p",
    "midpoint_band",
    "nullify",
    "one_hot",
    "percent",
    "position_code",
    "ratio",
    "recode",
    "row_sum",
    "strip",
    "threshold",
    "to_number",
]
