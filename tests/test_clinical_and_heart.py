import pytest

from chartmill.operators.duplicates import count_surplus, duplicate_report
from chartmill.operators.missing import cleaning_summary, missing_total
from chartmill.operators.profiling import group_rate, value_counts
from chartmill.plans import clinical, heart

ROWS = [
    ("P01", 55.0, "MALE", 130.0, 200.0, 27.0, "YES", "DIABETES", "2023-01-01", None),
    ("P02", None, "FEMALE", None, None, None, None, None, "2023-02-01", None),
    ("P03", 45.0, None, 140.0, 250.0, 30.0, "NO", "HEART DISEASE", "2023-03-01", "stable"),
    ("P04", 65.0, "male", 150.0, 220.0, 35.0, "Y", "diabetes", "2023-04-01", ""),
    ("P04", 65.0, "male", 150.0, 220.0, 35.0, "Y", "diabetes", "2023-04-01", ""),
]


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame(ROWS, clinical.SCHEMA)


def _by_id(df):
    return {r["Patient_ID"]: r for r in df.collect()}


def test_fill_values(patients):
    got = _by_id(clinical.clean(patients))
    second = got["P02"]
    assert (second["Age"], second["Blood_Pressure"], second["Cholesterol"], second["BMI"]) == (60.0, 142.5, 220.0, 31.75)
    assert (got["P03"]["Gender"], second["Smoker"], second["Diagnosis"]) == ("MALE", "YES", "UNKNOWN")
    assert {r["Notes"] for r in got.values()} == {"N/A", "STABLE"}
    assert got["P04"]["Diagnosis"] == "DIABETES"


def test_fill_values_without_duplicates(patients):
    cleaned = clinical.clean(patients, remove_duplicates=True)
    got = _by_id(cleaned)["P02"]
    assert cleaned.count() == 4
    assert (got["Age"], got["Blood_Pressure"], got["Cholesterol"]) == (55.0, 140.0, 220.0)
    assert got["BMI"] == pytest.approx(92 / 3)


def test_reports(patients):
    assert duplicate_report(patients).count() == 2
    assert count_surplus(patients).first()["surplus"] == 1
    assert missing_total(clinical.clean(patients)).first()["missing_total"] == 0
    ages = cleaning_summary(patients, clinical.clean(patients)).where("column = 'Age'").first()
    assert (ages["missing_before"], ages["missing_after"]) == (1, 0)


# Cells as read, sorted by fate: 5 lack a needed number, 2 are equal after cleaning, 2 are out of range.
HEART = [
    ("63", " male", "TA", "145", "233", "150", "fixed", "1", "", "x"),
    ("67", "FEMALE", "ATA", "160", "?", "108", "normal", "1", "", "x"),
    ("?", "M", "ASY", "130", "229", "130", "normal", "0", "", "x"),
    ("50", "M", "ASY", "null", "229", "130", "normal", "0", "", "x"),
    ("51", "f", "ASY", "130", "229", "n/a", "normal", "0", "", "x"),
    ("52", "f", "ASY", "130", "229", "120", "normal", None, "", "x"),
    ("57", "M", " nap ", "120", "354", "163", " Normal", "1", "dup", "?"),
    ("57", "m", "NAP", "120", "354.0", "163", "normal", "1", "other", "y"),
    ("17", "F", "TA", "120", "200", "150", "fixed", "0", "", ""),
    ("44", "F", "TA", "120", "600", "150", "fixed", "0", "", ""),
    ("44", None, "TA", "120", "599", "150", "fixed", "0", "", ""),
]
NAMES = ["age", " Sex ", "ChestPainType", "trestbps", "chol", "thalach", "thal", "target", "notes", "extra_col"]


def test_heart_table(spark):
    raw = spark.createDataFrame(HEART, ", ".join(f"`{n}` string" for n in NAMES))
    got = heart.clean(raw)
    assert got.columns == ["age", "sex", "cp", "trestbps", "chol", "thalach", "thal", "target"]
    rows = sorted((r["age"], r["sex"] or "", r["cp"], r["chol"], r["thal"]) for r in got.collect())
    assert rows == [(44.0, "", "TA", 599.0, "fixed"), (57.0, "male", "NAP", 354.0, "normal"), (63.0, "male", "TA", 233.0, "fixed")]
    assert {r["cp"]: r["rate_pct"] for r in group_rate(got, "cp", "target").collect()} == {"NAP": 100.0, "TA": 50.0}
    text = heart.clean(raw, null_text="nan")
    assert {r["sex"]: r["n"] for r in value_counts(text, "sex").collect()} == {"male": 2, "nan": 1}
