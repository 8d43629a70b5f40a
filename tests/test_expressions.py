"""Edge rows of the scalar expressions."""

import pytest
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C


@pytest.fixture()
def one(frame):
    """Value of an expression over a single row."""
    def run(expression, schema, *values):
        return frame([values], schema).select(expression.alias("v")).first()["v"]
    return run


@pytest.mark.parametrize("code, closed, half_open", [
    ("390", "circulatory", "circulatory"), ("459", "circulatory", "circulatory"),
    ("459.5", "other", "other"), ("250.5", "diabetes", "diabetes"),
    ("251", "diabetes", "other"), ("V57", "other", "other"), ("E888", "other", "other"),
    ("?", "other", "other"), (None, "other", "other"), (" 486 ", "respiratory", "respiratory"),
    ("250d", "other", "other"), ("140", "neoplasms", "neoplasms"), ("1000", "other", "other"),
])
def test_icd9_category(one, code, closed, half_open):
    assert one(C.icd9_category(F.col("c")), "c string", code) == closed
    assert one(C.icd9_category(F.col("c"), False), "c string", code) == half_open


def test_age(one):
    age = F.col("a")
    assert one(C.age_midpoint(age), "a string", "[70-80)") == 75
    assert one(C.age_midpoint(age, compat=True), "a string", "[70-80)") == 110
    assert one(C.age_group(age), "a string", "[70-80)") == "70-80"
    assert one(C.age_midpoint(age), "a string", "?") is None
    assert one(C.age_group(age), "a string", "?") is None


@pytest.mark.parametrize("years, seven, ten", [
    (0, "<30", "0-10"), (29, "<30", "20-30"), (30, "30-39", "30-40"), (99, "80+", "90-100"),
    (100, None, None), (-1, None, None), (None, None, None)])
def test_bin_age(one, years, seven, ten):
    assert one(C.bin_age(F.col("y")), "y int", years) == seven
    assert one(C.bin_age(F.col("y"), K.AGE_BINS_10), "y int", years) == ten


@pytest.mark.parametrize("values, mode", [
    (("b", "a", "c"), "a"), (("a", "b", "b"), "b"), ((None, "b", "a"), "a"),
    (("b", None, "b"), "b"), ((None, None, "z"), "z"), ((None, None, None), None)])
def test_dominant(one, values, mode):
    cols = [F.col(n) for n in "abc"]
    assert one(C.dominant(*cols), "a string, b string, c string", *values) == mode


@pytest.mark.parametrize("code, clean", [
    ("8", "00008"), ("250.83", "250.83"), ("5.1", "005.1"), ("V57", "00057"), ("?", ""),
    ("123456", "123456"), ("'401'", "00401"), (None, None)])
def test_normalize_icd9(one, code, clean):
    assert one(C.normalize_icd9(F.col("c")), "c string", code) == clean


@pytest.mark.parametrize("code, start", [
    ("00250", "Diabetes"), ("250.83", "Diabetes"), ("00428", "Congestive"), ("00999", "未知")])
def test_diagnosis_label(one, code, start):
    assert one(C.diagnosis_label(F.col("c")), "c string", code).startswith(start)


@pytest.mark.parametrize("code, name", [
    ("250.01", "Diabetes"), ("401", "Hypertension"), ("428", "Heart Disease"),
    ("415", "Other"), ("585", "Kidney Disease"), ("466", "Respiratory Disease"),
    ("467", "Other"), ("490", "Respiratory Disease"), ("519", "Respiratory Disease"),
    ("V45", "Other"), (None, "None")])
def test_categorize_disease(one, code, name):
    assert one(C.categorize_disease(F.col("c")), "c string", code) == name


@pytest.mark.parametrize("text, name", [
    ("Diseases of the circulatory system", "circulatory"), ("Hip Fracture", "injuries"),
    ("Chronic kidney disease", "genitourinary"), ("Breast cancer", "neoplasms"),
    ("Viral infection", "other"), (None, "other")])
def test_ccs_category(one, text, name):
    assert one(C.ccs_category(F.col("c")), "c string", text) == name


@pytest.mark.parametrize("dose, text", [
    ("Up", "Increased"), ("Down", "Decreased"), ("Steady", "No Change"), ("No", "Not Given"),
    (None, "Not Given"), ("x", "Not Given")])
def test_dose_change(one, dose, text):
    assert one(C.dose_change(F.col("c")), "c string", dose) == text


def test_icu_flag(one):
    assert one(C.icu_flag(F.col("c")), "c string", " emergency ROOM") == 1
    assert one(C.icu_flag(F.col("c")), "c string", "HMO Referral") == 0
    assert one(C.icu_flag(F.col("c")), "c string", None) == 0


@pytest.mark.parametrize("kind, expected", [
    ("binary", [1, 0, 0, 0]), ("multiclass", [2, 1, 0, None]), ("risk_level", [3, 1, 0, None])])
def test_encode_target(frame, kind, expected):
    df = frame([("<30",), (">30",), ("NO",), (None,)], "r string")
    assert [r.v for r in df.select(C.encode_target(F.col("r"), kind).alias("v")).collect()] == expected


def test_encode_target_unknown(spark):
    with pytest.raises(ValueError):
        C.encode_target(F.col("r"), "other")


@pytest.mark.parametrize("days, name", [
    (1, "Short Stay (1-3 days)"), (4, "Medium Stay (4-7 days)"), (14, "Long Stay (8-14 days)"),
    (15, "Extended Stay (15+ days)"), (None, "Extended Stay (15+ days)")])
def test_stay_category(one, days, name):
    assert one(C.stay_category(F.col("d")), "d int", days) == name


@pytest.mark.parametrize("feature, category", [
    ("race", "Demographic"), ("race_Asian", "Demographic"), ("diag_1_category", "Clinical"),
    ("diag_1_250", "Clinical"), ("age_group", "Demographic"), ("glyburide-metformin_Up",
                                                              "Medication"),
    ("change_Ch", "Administrative"), ("nothing", "Unknown"), ("races", "Unknown")])
def test_feature_category(one, feature, category):
    assert one(C.feature_category(F.col("f")), "f string", feature) == category
