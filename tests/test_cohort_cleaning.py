"""Cohort order, null handling, cleaning and data quality."""

import pytest
from pyspark.sql import functions as F

from wardwise.operators import cleaning as N
from wardwise.operators import cohort as H
from wardwise.operators import quality as Q


def test_death_in_first_stay_removes_the_patient(frame):
    df = frame([(1, 7, 11), (2, 7, 1), (3, 8, 1), (4, 9, None)],
               "encounter_id long, patient_nbr long, discharge_disposition_id int")
    kept = H.exclude_dispositions(H.index_admissions(df))
    assert sorted(r.encounter_id for r in kept.collect()) == [3, 4]


def test_index_admissions_limits_before_the_shuffle(clinic):
    plan = H.index_admissions(clinic.encounters)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_keeps_unmatched(clinic):
    merged = H.merge_codes(clinic.encounters, clinic.admission_type, clinic.discharge_disposition,
                           clinic.admission_source)
    assert merged.count() == clinic.encounters.count()
    assert merged.filter("discharge_disposition_desc IS NULL").count() > 0
    assert "admission_type_id" not in merged.columns
    assert "discharge_disposition_id" in merged.columns


def test_diabetes_cohorts_ignore_null(frame):
    df = frame([("250.1", None, None), (None, " 250", "1"), (None, None, None)],
               "diag_1 string, diag_2 string, diag_3 string")
    assert H.diabetes_any(df).count() == 2
    assert H.diabetes_primary(df).count() == 1
    masked = H.mask_diabetes_diagnoses(df).collect()
    assert masked[0].diag_1 is None and masked[1].diag_2 is None and masked[1].diag_3 == "1"


def test_sparse_columns_are_strictly_above(frame):
    df = frame([("?", "?", 1), ("?", "x", 1), ("y", "?", 1), ("?", "x", 1)],
               "a string, b string, c int")
    clean = N.replace_sentinel(df)
    assert N.drop_sparse_columns(clean).columns == ["b", "c"]
    assert N.drop_sparse_columns(clean, 75.0).columns == ["a", "b", "c"]


def test_fill_and_trim(frame):
    df = frame([(None, " x "), ("A", None)], "race string, other string")
    rows = N.trim_strings(N.fill_unknown(df)).collect()
    assert [tuple(r) for r in rows] == [("Unknown", "x"), ("A", None)]


def test_median_impute_is_exact(frame):
    df = frame([(1, "a"), (2, "a"), (None, "b"), (10, "c"), (20, "c")], "age int, t string")
    assert sorted(r.age for r in N.median_impute(df).collect()) == [1, 2, 6, 10, 20]


def test_coerce_types(frame):
    df = frame([("[70-80)", "7"), ("45", "x"), (None, "3.0"), ("12d", "0x1p3"), ("7f", " 8 ")],
               "age string, num_medications string")
    assert [tuple(r) for r in N.coerce_types(df).collect()] == [
        (None, 7), (45, None), (None, 3), (None, None), (None, 8)]


def test_validate_patients(frame):
    schema = "patient_id string, age int, time_in_hospital int, readmitted string"
    good = frame([("1", 5, 3, "NO"), ("2", 130, 400, "<30")], schema)
    row = Q.validate_patients(good).first()
    assert row.is_valid and not row.age_in_range and not row.stay_in_range
    bad = frame([("1", 5, 3, "maybe"), (None, 7, 2, None)], schema)
    row = Q.validate_patients(bad).first()
    assert not row.is_valid and row.invalid_readmitted == 2 and row.null_patient_id == 1
    assert sorted(map(tuple, Q.invalid_readmitted(bad).collect())) == [("(null)", 1), ("maybe", 1)]


def test_all_invalid_values_are_listed(frame):
    rows = [(str(i), 5, 3, f"odd{i % 15}") for i in range(30)]
    df = frame(rows, "patient_id string, age int, time_in_hospital int, readmitted string")
    assert Q.invalid_readmitted(df).count() == 15 == Q.validate_patients(df).first().invalid_readmitted


def test_key_checks(frame):
    p = frame([("1",), ("1",), (None,)], "patient_id string")
    m = frame([("1",), ("9",), ("9",), (None,)], "patient_id string")
    rows = {r["check"]: r.violations for r in Q.key_checks(
        {"p": p, "m": m}, {"p": "patient_id"}, [("m", "p", "patient_id")]).collect()}
    assert rows == {"primary:p.patient_id": 2, "foreign:m.patient_id->p": 1}


def test_medications_long(frame):
    df = frame([(1, "No", "Up"), (2, "Steady", None)],
               "encounter_id long, metformin string, `glyburide-metformin` string")
    rows = sorted(tuple(r) for r in Q.medications_long(df).collect())
    assert rows == [("1", "glyburide-metformin", "Up"), ("2", "metformin", "Steady")]


def test_reorder(frame):
    df = frame([(1, 2, 3, 4)], "diag_1_category int, diag_1 int, a int, b int")
    assert N.reorder_columns(df).columns == ["a", "b", "diag_1", "diag_1_category"]


def test_stamp(frame):
    out = N.stamp_created_at(frame([(1,)], "a int"))
    assert out.first().created_at is not None and dict(out.dtypes)["created_at"] == "timestamp"


@pytest.mark.parametrize("names", [["nothing"], ["a", "nothing"]])
def test_drop_columns_ignores_absent(frame, names):
    assert H.drop_columns(frame([(1, 2)], "a int, b int"), *names).columns[-1] == "b"
    assert isinstance(F.lit(1), object)
