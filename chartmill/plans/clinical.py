"""Small clinical table: duplicates, imputation and the before/after summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chartmill.functions import KEEP
from chartmill.operators.duplicates import drop_duplicate_rows
from chartmill.operators.encode import canonical_case, map_values
from chartmill.operators.missing import impute, nullify_tokens

SCHEMA = T.StructType(
    [
        T.StructField("Patient_ID", T.StringType()),
        T.StructField("Age", T.DoubleType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Blood_Pressure", T.DoubleType()),
        T.StructField("Cholesterol", T.DoubleType()),
        T.StructField("BMI", T.DoubleType()),
        T.StructField("Smoker", T.StringType()),
        T.StructField("Diagnosis", T.StringType()),
        T.StructField("Admission_Date", T.StringType()),
        T.StructField("Notes", T.StringType()),
    ]
)

# Spellings of the smoker answers, and the strategy for each column.
SMOKER_WORDS = {
    "Y": "YES",
    "y": "YES",
    "Yes": "YES",
    "yes": "YES",
    "N": "NO",
    "n": "NO",
    "No": "NO",
    "no": "NO",
}
STRATEGIES = {
    "Age": "median",
    "Gender": "mode",
    "Blood_Pressure": "mean",
    "Cholesterol": "median",
    "BMI": "mean",
    "Smoker": "mode",
    "Diagnosis": ("constant", "UNKNOWN"),
    "Notes": ("constant", "N/A"),
}
NUMERIC = ["Age", "Blood_Pressure", "Cholesterol", "BMI"]
CATEGORICAL = ["Gender", "Smoker", "Diagnosis"]


def clean(df: DataFrame, remove_duplicates: bool = False) -> DataFrame:
    """Null out text sentinels, canonicalise categories, then fill every column by its strategy."""
    rows = drop_duplicate_rows(df) if remove_duplicates else df
    rows = nullify_tokens(rows, ["nan", ""])
    rows = canonical_case(rows, ["Gender", "Diagnosis", "Notes"], "upper")
    rows = map_values(rows, "Smoker", SMOKER_WORDS, KEEP)
    return impute(rows, STRATEGIES)
