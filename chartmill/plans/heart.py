"""Messy heart-disease table: names, categories, numbers, missing rows, duplicates, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chartmill.functions import KEEP
from chartmill.operators.duplicates import drop_duplicate_rows
from chartmill.operators.encode import canonical_case, map_values
from chartmill.operators.missing import to_numeric
from chartmill.operators.rows import coalesce_column, drop_columns, drop_null_rows, filter_ranges, normalise_names

# Missing tokens, spellings, column roles and plausible ranges.
NA_TOKENS = ["?", "null", "NULL", "NaN", "nan", ""]
SEX_WORDS = {"m": "male", "male": "male", "f": "female", "female": "female"}
NUMERIC = ["age", "trestbps", "chol", "fbs", "restecg", "thalach", "exang", "oldpeak", "slope", "ca", "target"]
REQUIRED = ["target", "age", "trestbps", "chol", "thalach"]
RANGES = {"chol": (None, 600, "neither"), "age": (18, 100, "both")}


def clean(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """The whole cleaning. ``null_text='nan'`` turns missing categories into that text."""
    rows = coalesce_column(normalise_names(df), "cp", "chestpaintype")
    rows = canonical_case(rows, ["sex", "thal"], "lower", strip=True, null_text=null_text)
    rows = canonical_case(rows, ["cp"], "upper", strip=True, null_text=null_text)
    if "sex" in rows.columns:
        rows = map_values(rows, "sex", SEX_WORDS, KEEP)
    rows = to_numeric(rows, NUMERIC)
    rows = drop_columns(rows, ["notes", "extra_col"])
    rows = drop_null_rows(rows, REQUIRED)
    return filter_ranges(drop_duplicate_rows(rows), RANGES)
