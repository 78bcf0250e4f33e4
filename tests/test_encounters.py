import pytest
from pyspark.sql import functions as F

from chartmill.functions import icd9_category
from chartmill.plans import encounters as W


def _row(**given):
    base = {f.name: None for f in W.RAW_SCHEMA.fields}
    base.update(time_in_hospital=1, num_lab_procedures=1, num_procedures=0, num_medications=1)
    base.update(number_outpatient=0, number_emergency=0, number_inpatient=0, number_diagnoses=1)
    base.update(given)
    return tuple(base[f.name] for f in W.RAW_SCHEMA.fields)


FOURTH = dict(
    encounter_id=4, patient_nbr=101, discharge_disposition_id=12, age="[70-80)", gender="Unknown/Invalid",
    admission_type_id=1, admission_source_id=7, time_in_hospital=8, num_lab_procedures=50, number_outpatient=1,
    number_emergency=2, number_inpatient=3, number_diagnoses=9, A1Cresult=">8", insulin="Down", metformin="Up",
    glipizide="Up", glyburide="Down", diag_1="250.83", diag_2="428", diag_3="V57", change="Ch", diabetesMed="Yes",
    readmitted="<30",
)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        _row(encounter_id=1, patient_nbr=100, discharge_disposition_id=11, readmitted="NO"),
        _row(encounter_id=2, patient_nbr=100, discharge_disposition_id=1, readmitted=">30"),
        _row(encounter_id=3, patient_nbr=100, discharge_disposition_id=1, readmitted="<30"),
        _row(**FOURTH),
        _row(encounter_id=5, patient_nbr=102),
    ]
    return spark.createDataFrame(rows, W.RAW_SCHEMA)


def test_rows_that_stay(raw):
    got = W.clean(raw).select("discharge_disposition_id", "readmitted").collect()
    assert sorted((r[0], r[1] or "") for r in got) == [(1, ""), (1, ">30"), (12, "<30")]


def test_encoded_encounter(raw):
    got = W.clean(raw).where("readmitted_early = 1").first().asDict()
    expected = dict(
        gender="Female", gender_enc=0, race="Unknown", race_enc=5, age_numeric=75.0, a1c_result_enc=3, glu_serum_enc=0,
        insulin_enc=3, num_meds_changed=4, num_meds_used=4, admission_type_grp=0, discharge_grp=3, admission_source_grp=1,
        total_prior_visits=6, diag_1_cat_enc=0, diag_2_cat_enc=1, diag_3_cat_enc=8,
    )
    assert {k: got[k] for k in expected} == expected
    assert got["labs_per_day"] == pytest.approx(50 / 9)
    ones = """has_prior_inpatient high_risk_discharge insulin_down poor_glycaemic_control long_stay multimorbid
        diag_diabetes_any diag_circulatory_any is_a1c_tested high_prior_inpatient repeat_ed_user elderly_frequent_inpatient
        complex_diabetes_stay unstable_med_regimen diabetes_circulatory_comorbid er_frequent_readmitter
        high_intensity_complex high_risk_discharge_with_history severe_med_instability diag_1_diabetes""".split()
    zeros = ["is_glu_tested", "premature_discharge_risk", "young_uncontrolled_diabetes", "diag_1_other"]
    assert {k: got[k] for k in ones} == dict.fromkeys(ones, 1)
    assert {k: got[k] for k in zeros} == dict.fromkeys(zeros, 0)


def test_unknown_age_sets_no_flag(raw):
    got = W.clean(raw).where("readmitted is null").first()
    assert got["age_numeric"] is None and got["discharge_grp"] == 0
    assert got["elderly_frequent_inpatient"] == 0 and got["young_uncontrolled_diabetes"] == 0


def test_feature_list(raw):
    assert len(W.FEATURES) == len(set(W.FEATURES)) == 67
    assert len(W.MEDICATIONS) == 23
    assert set(W.FEATURES) <= set(W.clean(raw).columns)


@pytest.mark.parametrize(
    "codes,category",
    [
        (["250", "250.99"], "Diabetes"),
        (["459.9", "785", " 428 ", "\t390"], "Circulatory"),
        (["460", "786"], "Respiratory"),
        (["787", "520"], "Digestive"),
        (["629.9", "788"], "Genitourinary"),
        (["739"], "Musculoskeletal"),
        (["999.9"], "Injury"),
        (["239"], "Neoplasms"),
        (["251", "785.5", "740", "V57", "E909", "v57", "", "  ", None, "Other", "250d", "NaN", "1000"], "Other"),
    ],
)
def test_icd9(table, codes, category):
    df = table([(c,) for c in codes], "code string")
    assert {r[0] for r in df.select(icd9_category("code")).collect()} == {category}


def test_scoring_defaults(table):
    df = table([("male", "[40-50)", "Circulatory"), ("MALE", "ninety", None)], "gender string, age string, diag_1_category string")
    got = W.prepare_scoring(df).collect()
    assert [r["gender_enc"] for r in got] == [1, 1]
    assert [r["age_numeric"] for r in got] == [45.0, 55.0]
    assert [r["diag_1_cat_enc"] for r in got] == [1, 8]
    assert {(r["race_enc"], r["admission_type_grp"], r["discharge_grp"], r["insulin_enc"]) for r in got} == {(5, 3, 0, 0)}


def test_cleaning_shuffles_once(raw):
    plan = W.clean(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan
    assert "WindowGroupLimit" in plan and "Python" not in plan.replace("PythonRDD", "")


def test_batch_and_training_share_features(raw):
    scored = set(W.prepare_scoring(raw).columns)
    assert set(W.FEATURES) <= scored
    one = W.build_features(raw.where(F.col("encounter_id") == 4)).select(*W.FEATURES).first()
    two = W.clean(raw).where("readmitted_early = 1").select(*W.FEATURES).first()
    assert one == two
