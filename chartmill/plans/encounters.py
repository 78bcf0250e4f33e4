"""Hospital encounters: from the raw table to one encoded row per patient."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import (
    ICD9_CATEGORIES,
    KEEP,
    all_of,
    any_of,
    band_midpoint,
    col_of,
    count_where,
    equals,
    group_codes,
    icd9_category,
    in_set,
    one_hot,
    position_code,
    ratio,
    recode,
    row_sum,
    threshold,
)
from chartmill.functions.codes import ICD9_RANGES
from chartmill.operators.duplicates import first_per_key
from chartmill.operators.missing import fill_constant, number_of
from chartmill.operators.rows import drop_columns, exclude_values

# The medication columns of the raw table.
MEDICATIONS = [
    "metformin",
    "repaglinide",
    "nateglinide",
    "chlorpropamide",
    "glimepiride",
    "acetohexamide",
    "glipizide",
    "glyburide",
    "tolbutamide",
    "pioglitazone",
    "rosiglitazone",
    "acarbose",
    "miglitol",
    "troglitazone",
    "tolazamide",
    "examide",
    "citoglipton",
    "insulin",
    "glyburide-metformin",
    "glipizide-metformin",
    "glimepiride-pioglitazone",
    "metformin-rosiglitazone",
    "metformin-pioglitazone",
]

# Codes of categories, and code groups with the group of all other codes.
A1C_CODES = {"None": 0, "Norm": 1, ">7": 2, ">8": 3}
GLUCOSE_CODES = {"None": 0, "Norm": 1, ">200": 2, ">300": 3}
MEDICATION_CODES = {"No": 0, "Steady": 1, "Up": 2, "Down": 3}
RACE_CODES = {"Caucasian": 0, "AfricanAmerican": 1, "Hispanic": 2, "Asian": 3, "Other": 4, "Unknown": 5}
ADMISSION_TYPE_GROUPS = {0: [1], 1: [2], 2: [3]}
DISCHARGE_GROUPS = {0: [1], 1: [2, 3, 4, 5, 10], 2: [6, 8]}
ADMISSION_SOURCE_GROUPS = {0: [1], 1: [7], 2: [4, 5, 6]}
OTHER_GROUP = 3
DECEASED_CODES = [11, 19, 20]
HIGH_RISK_DISCHARGE_CODES = [9, 12, 15, 22, 28]

# The model's input columns, by theme.
FEATURES = [
    # who
    "age_numeric",
    "gender_enc",
    "race_enc",
    # stay
    "time_in_hospital",
    "admission_type_grp",
    "discharge_grp",
    "discharge_disposition_id",
    "admission_source_grp",
    # volume
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
    # labs
    "a1c_result_enc",
    "glu_serum_enc",
    # medications
    "insulin_enc",
    "metformin_enc",
    "glipizide_enc",
    "glyburide_enc",
    "glimepiride_enc",
    "pioglitazone_enc",
    "rosiglitazone_enc",
    "repaglinide_enc",
    "change_enc",
    "diabetes_med_enc",
    "num_meds_changed",
    "num_meds_used",
    # derived flags
    "total_prior_visits",
    "has_prior_inpatient",
    "high_risk_discharge",
    "insulin_down",
    "poor_glycaemic_control",
    "long_stay",
    "multimorbid",
    # per day of stay
    "labs_per_day",
    "procedures_per_day",
    "meds_per_day",
    # diagnoses in any position
    "diag_diabetes_any",
    "diag_circulatory_any",
    # tests ordered
    "is_a1c_tested",
    "is_glu_tested",
    # prior care
    "high_prior_inpatient",
    "repeat_ed_user",
    # combinations
    "elderly_frequent_inpatient",
    "complex_diabetes_stay",
    "unstable_med_regimen",
    "diabetes_circulatory_comorbid",
    "premature_discharge_risk",
    "er_frequent_readmitter",
    "high_intensity_complex",
    "young_uncontrolled_diabetes",
    "high_risk_discharge_with_history",
    "severe_med_instability",
    # diagnosis codes
    "diag_1_cat_enc",
    "diag_2_cat_enc",
    "diag_3_cat_enc",
    *[f"diag_1_{c.lower()}" for c in ICD9_CATEGORIES],
]
TARGET = "readmitted_early"

CLUSTER_FEATURES = [
    "age_numeric",
    "time_in_hospital",
    "num_lab_procedures",
    "num_medications",
    "number_inpatient",
    "number_diagnoses",
    "total_prior_visits",
    "num_meds_changed",
    "num_meds_used",
    "a1c_result_enc",
    "insulin_enc",
]
CLUSTER_LOG_FEATURES = [
    "num_lab_procedures",
    "num_medications",
    "number_inpatient",
    "number_diagnoses",
    "total_prior_visits",
    "num_meds_used",
]

_DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
_COUNTS = [
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("encounter_id", "patient_nbr")]
    + [T.StructField(c, T.StringType()) for c in ("race", "gender", "age", "weight")]
    + [
        T.StructField(c, T.IntegerType())
        for c in ("admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital")
    ]
    + [T.StructField(c, T.StringType()) for c in ("payer_code", "medical_specialty")]
    + [T.StructField(c, T.IntegerType()) for c in _COUNTS[1:7]]
    + [T.StructField(c, T.StringType()) for c in _DIAGNOSES]
    + [T.StructField("number_diagnoses", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("max_glu_serum", "A1Cresult", *MEDICATIONS)]
    + [T.StructField(c, T.StringType()) for c in ("change", "diabetesMed", "readmitted")]
)
RAW_NA_TOKENS = ["?"]


@dataclass(frozen=True)
class EncounterRules:
    """Which codes mean what; the defaults are the reference's."""

    excluded_discharges: tuple = tuple(DECEASED_CODES)
    high_risk_discharges: tuple = tuple(HIGH_RISK_DISCHARGE_CODES)
    admission_types: Mapping = field(default_factory=lambda: ADMISSION_TYPE_GROUPS)
    discharges: Mapping = field(default_factory=lambda: DISCHARGE_GROUPS)
    admission_sources: Mapping = field(default_factory=lambda: ADMISSION_SOURCE_GROUPS)
    positive_outcome: str = "<30"


def build_features(df: DataFrame, rules: EncounterRules = EncounterRules()) -> DataFrame:
    """Add all derived columns. The one definition, for training and for scoring.

    Four projections, each on columns of the one before; no row moves.
    """
    return df.transform(_clean_inputs).transform(lambda d: _codes(d, rules)).transform(_levels).transform(_combinations)


def _clean_inputs(df: DataFrame) -> DataFrame:
    filled = fill_constant(
        df,
        {
            "race": "Unknown",
            "A1Cresult": "None",
            "max_glu_serum": "None",
            **{d: "Other" for d in _DIAGNOSES},
            **{m: "No" for m in MEDICATIONS},
        },
    )
    return filled.withColumns(
        {
            "gender": recode("gender", {"Unknown/Invalid": "Female"}, KEEP),
            "discharge_disposition_id": number_of(filled, "discharge_disposition_id", "int", 1),
        }
    )


def _codes(df: DataFrame, rules: EncounterRules) -> DataFrame:
    """Codes and groups read straight from one input column each."""
    new: dict[str, Column] = {
        "age_numeric": band_midpoint("age"),
        "gender_enc": equals("gender", "Male"),
        "race_enc": recode("race", RACE_CODES, RACE_CODES["Unknown"]),
        "a1c_result_enc": recode("A1Cresult", A1C_CODES, 0),
        "glu_serum_enc": recode("max_glu_serum", GLUCOSE_CODES, 0),
        **{f"{m}_enc": recode(m, MEDICATION_CODES, 0) for m in MEDICATIONS},
        "admission_type_grp": group_codes("admission_type_id", rules.admission_types, OTHER_GROUP),
        "discharge_grp": group_codes("discharge_disposition_id", rules.discharges, OTHER_GROUP),
        "admission_source_grp": group_codes("admission_source_id", rules.admission_sources, OTHER_GROUP),
        **{f"{d}_category": icd9_category(d) for d in _DIAGNOSES},
        "change_enc": equals("change", "Ch"),
        "diabetes_med_enc": equals("diabetesMed", "Yes"),
        "high_risk_discharge": in_set("discharge_disposition_id", rules.high_risk_discharges),
    }
    if "readmitted" in df.columns:
        new[TARGET] = equals("readmitted", rules.positive_outcome)
    return df.select("*", *[c.alias(name) for name, c in new.items()])


def _levels(df: DataFrame) -> DataFrame:
    """Counts, ratios and flags on the codes."""
    encoded = [f"{m}_enc" for m in MEDICATIONS]
    categories = [f"{d}_category" for d in _DIAGNOSES]
    new: dict[str, Column] = {
        "num_meds_changed": count_where(encoded, lambda c: c.isin(2, 3)),
        "num_meds_used": count_where(encoded, lambda c: c >= 1),
        **{f"{d}_cat_enc": position_code(f"{d}_category", ICD9_CATEGORIES) for d in _DIAGNOSES},
        "total_prior_visits": row_sum(["number_outpatient", "number_emergency", "number_inpatient"]),
        "has_prior_inpatient": threshold("number_inpatient", ">", 0),
        "insulin_down": equals("insulin_enc", 3),
        "poor_glycaemic_control": all_of(F.col("a1c_result_enc") >= 2, F.col("insulin_enc") >= 1),
        "long_stay": threshold("time_in_hospital", ">=", 7),
        "multimorbid": threshold("number_diagnoses", ">=", 7),
        "labs_per_day": ratio("num_lab_procedures", "time_in_hospital"),
        "procedures_per_day": ratio("num_procedures", "time_in_hospital"),
        "meds_per_day": ratio("num_medications", "time_in_hospital"),
        "diag_diabetes_any": any_of(*[col_of(c) == "Diabetes" for c in categories]),
        "diag_circulatory_any": any_of(*[col_of(c) == "Circulatory" for c in categories]),
        "is_a1c_tested": threshold("a1c_result_enc", ">", 0),
        "is_glu_tested": threshold("glu_serum_enc", ">", 0),
        "high_prior_inpatient": threshold("number_inpatient", ">=", 3),
        "repeat_ed_user": threshold("number_emergency", ">=", 2),
    }
    flags = [c for c in one_hot("diag_1_category", ICD9_CATEGORIES, "diag_1_")]
    return df.select("*", *[c.alias(name) for name, c in new.items()], *flags)


def _combinations(df: DataFrame) -> DataFrame:
    """Flags that join several of the columns above."""
    at = F.col
    new: dict[str, Column] = {
        "elderly_frequent_inpatient": all_of(at("age_numeric") >= 70, at("number_inpatient") >= 2),
        "complex_diabetes_stay": all_of(at("poor_glycaemic_control") == 1, at("long_stay") == 1),
        "unstable_med_regimen": all_of(at("num_meds_changed") >= 3, at("admission_source_grp") == 1),
        "diabetes_circulatory_comorbid": all_of(at("diag_diabetes_any") == 1, at("diag_circulatory_any") == 1),
        "premature_discharge_risk": all_of(at("time_in_hospital") <= 2, at("insulin_down") == 1),
        "er_frequent_readmitter": all_of(at("admission_source_grp") == 1, at("number_inpatient") >= 2),
        "high_intensity_complex": all_of(at("labs_per_day") >= 5, at("multimorbid") == 1, at("long_stay") == 1),
        "young_uncontrolled_diabetes": all_of(at("age_numeric") < 40, at("a1c_result_enc") >= 3),
        "high_risk_discharge_with_history": all_of(at("high_risk_discharge") == 1, at("has_prior_inpatient") == 1),
        "severe_med_instability": threshold("num_meds_changed", ">=", 4),
    }
    return df.select("*", *[c.alias(name) for name, c in new.items()])


def clean(raw: DataFrame, rules: EncounterRules = EncounterRules()) -> DataFrame:
    """Raw encounters to encoded rows: no deceased, each patient's first remaining encounter.

    The exclusion comes before the choice of the first encounter; one exchange, by patient.
    """
    kept = exclude_values(raw, "discharge_disposition_id", rules.excluded_discharges)
    kept = drop_columns(kept, ["weight", "payer_code", "medical_specialty"])
    first = first_per_key(kept, "patient_nbr", "encounter_id")
    return build_features(drop_columns(first, ["encounter_id", "patient_nbr"]), rules)


# What a scoring request that leaves a column out is taken to say.
SCORING_DEFAULTS = {
    "age": "[50-60)",
    "gender": "Female",
    "race": "Unknown",
    "admission_type_id": 8,
    "discharge_disposition_id": 1,
    "admission_source_id": 1,
    "change": "No",
    "diabetesMed": "No",
    "diag_1": "Other",
    "diag_2": "Other",
    "diag_3": "Other",
    **{c: 0 for c in _COUNTS},
}


#: What a model takes a missing number for, in training and in scoring: the middle of the default age band, and no visits.
MISSING_NUMBERS = {"age_numeric": 55, **{c: 0 for c in ("number_inpatient", "total_prior_visits")}}


def model_inputs(df: DataFrame) -> DataFrame:
    """Feature rows without missing numbers, by one rule for training and scoring."""
    return df.fillna(MISSING_NUMBERS)


def prepare_scoring(df: DataFrame, rules: EncounterRules = EncounterRules()) -> DataFrame:
    """Raw rows of a scoring request to feature columns, with a default for what is missing.

    Gender is matched in any case, and an age of unknown form counts as the default age.
    """
    if "diag_1_category" in df.columns:
        # A request may name the disease category instead of a code.
        codes = {name: str(low) for name, low, *_ in ICD9_RANGES}
        named = recode("diag_1_category", codes, SCORING_DEFAULTS["diag_1"])
        df = df.withColumn("diag_1", named).drop("diag_1_category")
    absent = {c: v for c, v in SCORING_DEFAULTS.items() if c not in df.columns}
    texts = [c for c in ("A1Cresult", "max_glu_serum", *MEDICATIONS) if c not in df.columns]
    full = df.select(
        "*",
        *[F.lit(v).alias(c) for c, v in absent.items()],
        *[F.lit(None).cast("string").alias(c) for c in texts],
    )
    full = fill_constant(full, SCORING_DEFAULTS)
    known_age = band_midpoint("age").isNotNull()
    full = full.withColumns(
        {
            "gender": F.when(F.lower("gender") == "male", "Male").otherwise("Female"),
            "age": F.when(known_age, F.col("age")).otherwise(F.lit(SCORING_DEFAULTS["age"])),
        }
    )
    return model_inputs(build_features(full, rules))
