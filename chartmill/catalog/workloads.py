"""Queries that run the whole workloads on tables of their shape, made from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartmill.catalog.base import Query, Tables, register
from chartmill.functions import flag
from chartmill.operators import models as Z
from chartmill.operators.duplicates import first_per_key
from chartmill.operators.missing import cleaning_summary
from chartmill.operators.profiling import group_rate_count
from chartmill.operators.rows import exclude_values, select_features
from chartmill.plans import clinical, encounters, heart

CATALOG: dict[str, Query] = {}


# ---------------------------------------------------------------- the flagship: rate per category, one row per key


@register(
    CATALOG,
    """
    WITH k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders
               WHERE o_orderpriority <> '5-LOW')
    SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 8) AS rate, count(*) AS n
    FROM k WHERE r = 1 GROUP BY 1
    """,
)
def early_return_rate(t):
    kept = exclude_values(t.orders, "o_orderpriority", ["5-LOW"])
    first = first_per_key(kept, "o_custkey", "o_orderkey").withColumn("y", flag(F.col("o_orderstatus") == "F"))
    return group_rate_count(first, "o_orderpriority", "y").withColumn("rate", F.round("rate", 8))


# ---------------------------------------------------------------- encounters


def _pick(expr: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _text(values: list) -> list:
    return ["NULL" if v is None else f"'{v}'" for v in values]


def _encounter_columns(quote: str) -> list[str]:
    """Raw encounters from orders: patient = customer, encounter = order, the rest from the keys."""
    k, c = "o_orderkey", "o_custkey"
    cols = {
        "encounter_id": k,
        "patient_nbr": c,
        "race": _pick(f"{c} % 7", _text(["Caucasian", "AfricanAmerican", "Hispanic", "Asian", "Other", None, "Martian"])),
        "gender": _pick(f"{c} % 5", _text(["Male", "Female", "Female", "Unknown/Invalid", "Male"])),
        "age": _pick(f"{k} % 12", [f"'[{a}-{a + 10})'" for a in range(0, 100, 10)] + ["NULL", "'old'"]),
        "weight": "'?'",
        "admission_type_id": f"CAST({k} % 9 AS INT)",
        "discharge_disposition_id": f"CASE WHEN {k} % 37 = 0 THEN NULL ELSE CAST({k} % 31 AS INT) END",
        "admission_source_id": f"CASE WHEN {k} % 29 = 0 THEN NULL ELSE CAST({c} % 9 AS INT) END",
        "time_in_hospital": f"CAST({k} % 14 + 1 AS INT)",
        "payer_code": "'x'",
        "medical_specialty": "'y'",
        "num_lab_procedures": f"CAST({k} % 133 AS INT)",
        "num_procedures": f"CAST({k} % 7 AS INT)",
        "num_medications": f"CAST({c} % 81 AS INT)",
        "number_outpatient": f"CAST({c} % 5 AS INT)",
        "number_emergency": f"CAST({k} % 4 AS INT)",
        "number_inpatient": f"CASE WHEN {k} % 23 = 0 THEN NULL ELSE CAST({k} % 6 AS INT) END",
        "number_diagnoses": f"CAST({c} % 16 + 1 AS INT)",
        "diag_1": _pick(f"{k} % 11", _text(["250.83", "428", "786", "V57", None, "560", "590.1", "715", "820", "E909", "174"])),
        "diag_2": _pick(f"{c} % 6", _text(["250", "785", "x12", " 410 ", None, "998"])),
        "diag_3": _pick(f"{k} % 4", _text(["276", "401.9", "250.02", None])),
        "max_glu_serum": _pick(f"{k} % 5", _text([None, "None", "Norm", ">200", ">300"])),
        "A1Cresult": _pick(f"{c} % 5", _text([None, "None", "Norm", ">7", ">8"])),
        "change": _pick(f"{k} % 3", _text(["Ch", "No", None])),
        "diabetesMed": _pick(f"{c} % 3", _text(["Yes", "No", "Yes"])),
        "readmitted": _pick(f"{k} % 5", _text(["NO", ">30", "<30", "NO", None])),
    }
    for i, m in enumerate(encounters.MEDICATIONS):
        cols[m] = _pick(f"({k} + {c} * {i + 3}) % {5 + i % 7}", _text(["No", "Steady", "Up", "Down", None] + ["No"] * (i % 7)))
    return [f"{expr} AS {quote}{name}{quote}" for name, expr in cols.items()]


def raw_encounters(t: Tables):
    return t.orders.selectExpr(*_encounter_columns("`"))


def _category_sql(c: str) -> str:
    v = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"""CASE WHEN {c} IS NULL OR trim({c})[1] IN ('V', 'E') OR {v} IS NULL THEN 'Other'
        WHEN {v} >= 250 AND {v} < 251 THEN 'Diabetes' WHEN {v} >= 390 AND {v} < 460 OR {v} = 785 THEN 'Circulatory'
        WHEN {v} >= 460 AND {v} < 520 OR {v} = 786 THEN 'Respiratory' WHEN {v} >= 520 AND {v} < 580 OR {v} = 787 THEN 'Digestive'
        WHEN {v} >= 580 AND {v} < 630 OR {v} = 788 THEN 'Genitourinary' WHEN {v} >= 710 AND {v} < 740 THEN 'Musculoskeletal'
        WHEN {v} >= 800 AND {v} < 1000 THEN 'Injury' WHEN {v} >= 140 AND {v} < 240 THEN 'Neoplasms' ELSE 'Other' END"""


def _yes(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def _encounters_sql() -> str:
    raw = ", ".join(_encounter_columns('"'))
    meds = {m: f"CASE \"{m}\" WHEN 'Steady' THEN 1 WHEN 'Up' THEN 2 WHEN 'Down' THEN 3 ELSE 0 END" for m in encounters.MEDICATIONS}
    changed = " + ".join(f"CAST({e} >= 2 AS INTEGER)" for e in meds.values())
    used = " + ".join(f"CAST({e} >= 1 AS INTEGER)" for e in meds.values())
    named = ["insulin", "metformin", "glipizide", "glyburide", "glimepiride", "pioglitazone", "rosiglitazone", "repaglinide"]
    categories = encounters.ICD9_CATEGORIES
    listed = "[" + ", ".join(f"'{c}'" for c in categories) + "]"
    return f"""
    WITH raw AS (SELECT {raw} FROM orders),
    kept AS (SELECT *, row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) AS r FROM raw
             WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 19, 20)),
    a AS (SELECT * REPLACE (coalesce(discharge_disposition_id, 1) AS discharge_disposition_id),
            CASE WHEN age LIKE '[%' THEN CAST(split_part(age[2:], '-', 1) AS DOUBLE) + 5 END AS age_numeric,
            {_yes("gender = 'Male'")} AS gender_enc,
            CASE race WHEN 'Caucasian' THEN 0 WHEN 'AfricanAmerican' THEN 1 WHEN 'Hispanic' THEN 2 WHEN 'Asian' THEN 3
                      WHEN 'Other' THEN 4 ELSE 5 END AS race_enc,
            CASE WHEN admission_type_id IN (1, 2, 3) THEN admission_type_id - 1 ELSE 3 END AS admission_type_grp,
            CASE WHEN admission_source_id = 1 THEN 0 WHEN admission_source_id = 7 THEN 1
                 WHEN admission_source_id IN (4, 5, 6) THEN 2 ELSE 3 END AS admission_source_grp,
            CASE A1Cresult WHEN 'Norm' THEN 1 WHEN '>7' THEN 2 WHEN '>8' THEN 3 ELSE 0 END AS a1c_result_enc,
            CASE max_glu_serum WHEN 'Norm' THEN 1 WHEN '>200' THEN 2 WHEN '>300' THEN 3 ELSE 0 END AS glu_serum_enc,
            {", ".join(f"{meds[m]} AS {m}_enc" for m in named)},
            {changed} AS num_meds_changed, {used} AS num_meds_used,
            {_yes("change = 'Ch'")} AS change_enc, {_yes("diabetesMed = 'Yes'")} AS diabetes_med_enc,
            number_outpatient + number_emergency + number_inpatient AS total_prior_visits,
            {_category_sql("diag_1")} AS d1, {_category_sql("diag_2")} AS d2, {_category_sql("diag_3")} AS d3
          FROM kept WHERE r = 1),
    b AS (SELECT *, CASE WHEN discharge_disposition_id = 1 THEN 0 WHEN discharge_disposition_id IN (2, 3, 4, 5, 10) THEN 1
                         WHEN discharge_disposition_id IN (6, 8) THEN 2 ELSE 3 END AS discharge_grp,
            {_yes("number_inpatient > 0")} AS has_prior_inpatient,
            {_yes("discharge_disposition_id IN (9, 12, 15, 22, 28)")} AS high_risk_discharge,
            {_yes("insulin_enc = 3")} AS insulin_down, {_yes("a1c_result_enc >= 2 AND insulin_enc >= 1")} AS poor_glycaemic_control,
            {_yes("time_in_hospital >= 7")} AS long_stay, {_yes("number_diagnoses >= 7")} AS multimorbid,
            num_lab_procedures / (time_in_hospital + 1) AS labs_per_day,
            num_procedures / (time_in_hospital + 1) AS procedures_per_day,
            num_medications / (time_in_hospital + 1) AS meds_per_day,
            {_yes("'Diabetes' IN (d1, d2, d3)")} AS diag_diabetes_any,
            {_yes("'Circulatory' IN (d1, d2, d3)")} AS diag_circulatory_any,
            {_yes("a1c_result_enc > 0")} AS is_a1c_tested, {_yes("glu_serum_enc > 0")} AS is_glu_tested,
            {_yes("number_inpatient >= 3")} AS high_prior_inpatient, {_yes("number_emergency >= 2")} AS repeat_ed_user,
            CAST(list_position({listed}, d1) - 1 AS INTEGER) AS diag_1_cat_enc,
            CAST(list_position({listed}, d2) - 1 AS INTEGER) AS diag_2_cat_enc,
            CAST(list_position({listed}, d3) - 1 AS INTEGER) AS diag_3_cat_enc,
            {", ".join(f"{_yes(f'''d1 = '{c}' ''')} AS diag_1_{c.lower()}" for c in categories)}
          FROM a),
    c AS (SELECT *, {_yes("age_numeric >= 70 AND number_inpatient >= 2")} AS elderly_frequent_inpatient,
            {_yes("poor_glycaemic_control = 1 AND long_stay = 1")} AS complex_diabetes_stay,
            {_yes("num_meds_changed >= 3 AND admission_source_grp = 1")} AS unstable_med_regimen,
            {_yes("diag_diabetes_any = 1 AND diag_circulatory_any = 1")} AS diabetes_circulatory_comorbid,
            {_yes("time_in_hospital <= 2 AND insulin_down = 1")} AS premature_discharge_risk,
            {_yes("admission_source_grp = 1 AND number_inpatient >= 2")} AS er_frequent_readmitter,
            {_yes("labs_per_day >= 5 AND multimorbid = 1 AND long_stay = 1")} AS high_intensity_complex,
            {_yes("age_numeric < 40 AND a1c_result_enc >= 3")} AS young_uncontrolled_diabetes,
            {_yes("high_risk_discharge = 1 AND has_prior_inpatient = 1")} AS high_risk_discharge_with_history,
            {_yes("num_meds_changed >= 4")} AS severe_med_instability,
            {_yes("readmitted = '<30'")} AS readmitted_early
          FROM b)
    SELECT {", ".join(encounters.FEATURES)}, readmitted_early FROM c
    """


@register(CATALOG, _encounters_sql())
def encounter_features(t):
    cleaned = encounters.clean(raw_encounters(t))
    return select_features(cleaned, encounters.FEATURES, encounters.TARGET)


@register(CATALOG)
def scored_encounters(t):
    raw = raw_encounters(t)
    cleaned = encounters.model_inputs(encounters.clean(raw))
    model = Z.train_gbt(cleaned, encounters.FEATURES, encounters.TARGET, Z.BoostConfig(trees=3, depth=3))
    requests = raw.select("encounter_id", "age", "gender", "race", "time_in_hospital", "insulin", "A1Cresult", "diag_1")
    scored = Z.score_batch(model, encounters.prepare_scoring(requests))
    return scored.select("encounter_id", "prediction", "p0", "p1", "label_text", "low_risk_pct", "high_risk_pct")


# ---------------------------------------------------------------- clinical table


def _clinical_columns(string: str) -> list[str]:
    k = "c_custkey"
    return [
        f"CAST({k} AS {string}) AS Patient_ID",
        f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE CAST({k} % 80 + 18 AS DOUBLE) END AS Age",
        f"CASE {k} % 6 WHEN 0 THEN NULL WHEN 1 THEN 'male' WHEN 2 THEN 'Female' WHEN 3 THEN 'nan' WHEN 4 THEN 'MALE' ELSE '' END AS Gender",
        f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE c_acctbal END AS Blood_Pressure",
        f"CASE WHEN {k} % 11 = 0 THEN NULL ELSE c_acctbal / 2 + {k} % 3 END AS Cholesterol",
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE CAST({k} % 20 + 20 AS DOUBLE) END AS BMI",
        f"CASE {k} % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Y' WHEN 2 THEN 'n' WHEN 3 THEN 'Yes' WHEN 4 THEN 'no' WHEN 5 THEN 'YES' ELSE 'NO' END AS Smoker",
        f"CASE WHEN {k} % 4 = 0 THEN NULL ELSE c_mktsegment END AS Diagnosis",
        "'2023-01-01' AS Admission_Date",
        f"CASE {k} % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'stable' END AS Notes",
    ]


def raw_clinical(t: Tables):
    """Customers as patients; every fourth one is listed twice."""
    times = F.when(F.col("c_custkey") % 4 == 1, 2).otherwise(1)
    listed = t.customer.withColumn("_time", F.explode(F.sequence(F.lit(1), times)))
    return listed.selectExpr(*_clinical_columns("STRING"))


_CLINICAL = f"""
    WITH raw AS (SELECT {", ".join(_clinical_columns("VARCHAR"))} FROM customer),
    twice AS (SELECT raw.* FROM raw, LATERAL (SELECT unnest(range(CASE WHEN CAST(Patient_ID AS BIGINT) % 4 = 1 THEN 2 ELSE 1 END))))
"""
_CLEAN = """,
    n AS (SELECT * REPLACE (upper(CASE WHEN Gender IN ('nan', '') THEN NULL ELSE Gender END) AS Gender,
                            upper(Diagnosis) AS Diagnosis, upper(nullif(Notes, '')) AS Notes,
                            CASE WHEN lower(Smoker) IN ('y', 'yes') THEN 'YES' WHEN lower(Smoker) IN ('n', 'no') THEN 'NO' END AS Smoker)
          FROM {source}),
    f AS (SELECT Patient_ID, coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM n)) AS Age,
             coalesce(Gender, (SELECT Gender FROM n WHERE Gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS Gender,
             round(coalesce(Blood_Pressure, (SELECT avg(Blood_Pressure) FROM n)), 6) AS Blood_Pressure,
             round(coalesce(Cholesterol, (SELECT quantile_cont(Cholesterol, 0.5) FROM n)), 6) AS Cholesterol,
             round(coalesce(BMI, (SELECT avg(BMI) FROM n)), 6) AS BMI,
             coalesce(Smoker, (SELECT Smoker FROM n WHERE Smoker IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS Smoker,
             coalesce(Diagnosis, 'UNKNOWN') AS Diagnosis, Admission_Date, coalesce(Notes, 'N/A') AS Notes FROM n)
"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("Blood_Pressure", "Cholesterol", "BMI")})


@register(CATALOG, _CLINICAL + _CLEAN.format(source="twice") + " SELECT * FROM f")
def clinical_table(t):
    return _rounded(clinical.clean(raw_clinical(t)))


@register(CATALOG, _CLINICAL + _CLEAN.format(source="raw") + " SELECT * FROM f")
def clinical_table_without_duplicates(t):
    return _rounded(clinical.clean(raw_clinical(t), remove_duplicates=True))


_CLINICAL_COLUMNS = [c.rpartition(" AS ")[2] for c in _clinical_columns("VARCHAR")]


@register(
    CATALOG,
    _CLINICAL
    + _CLEAN.format(source="twice")
    + " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", (SELECT count(*) FROM twice) AS rows_before,
          (SELECT count(*) - count({c}) FROM twice) AS missing_before, CAST({len(_CLINICAL_COLUMNS)} AS INTEGER) AS columns_before,
          count(*) AS rows_after, count(*) - count({c}) AS missing_after, CAST({len(_CLINICAL_COLUMNS)} AS INTEGER) AS columns_after
        FROM f
        """
        for c in _CLINICAL_COLUMNS
    ),
)
def clinical_summary(t):
    raw = raw_clinical(t)
    return cleaning_summary(raw, clinical.clean(raw))


# ---------------------------------------------------------------- heart-disease table


def _heart_columns(string: str, quote: str) -> list[str]:
    k = "l_partkey"
    number = f"CAST(CAST(l_quantity AS INT) AS {string})"
    cols = {
        "age": f"CASE WHEN {k} % 13 = 0 THEN '?' WHEN {k} % 13 = 1 THEN '12' ELSE {number} END",
        " Sex ": _pick(f"{k} % 5", _text([" M", "male", "FEMALE ", "f", None])),
        "ChestPainType": _pick("l_linenumber % 4", _text([" NAP ", "asy", "TA", "ATA"])),
        "trestbps": f"CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey AS {string}) END",
        "chol": f"CASE WHEN {k} % 19 = 0 THEN 'high' ELSE CAST({k} % 700 AS {string}) END",
        "thalach": f"CAST(l_linenumber * 10 AS {string})",
        "thal": _pick("l_suppkey % 3", _text([" Fixed", "NORMAL", "reversable "])),
        "target": "CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' END",
        "notes": "'dup'",
        "extra_col": "'?'",
    }
    return [f"{expr} AS {quote}{name}{quote}" for name, expr in cols.items()]


def raw_heart(t: Tables):
    return t.lineitem.selectExpr(*_heart_columns("STRING", "`"))


@register(
    CATALOG,
    f"""
    WITH raw AS (SELECT {", ".join(_heart_columns("VARCHAR", '"'))} FROM lineitem)
    SELECT DISTINCT * FROM (
      SELECT TRY_CAST(age AS DOUBLE) AS age,
             CASE WHEN lower(trim(" Sex ")) IN ('m', 'male') THEN 'male' WHEN lower(trim(" Sex ")) IN ('f', 'female') THEN 'female'
             END AS sex,
             upper(trim(ChestPainType)) AS cp, TRY_CAST(trestbps AS DOUBLE) AS trestbps, TRY_CAST(chol AS DOUBLE) AS chol,
             TRY_CAST(thalach AS DOUBLE) AS thalach, lower(trim(thal)) AS thal, TRY_CAST(target AS DOUBLE) AS target
      FROM raw)
    WHERE target IS NOT NULL AND age BETWEEN 18 AND 100 AND trestbps IS NOT NULL AND chol < 600 AND thalach IS NOT NULL
    """,
)
def heart_table(t):
    return heart.clean(raw_heart(t))
