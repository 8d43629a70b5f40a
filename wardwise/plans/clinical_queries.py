"""Queries of cohorts, joins, derived features and cleaning."""

from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators import cleaning as N
from wardwise.operators import cohort as H
from wardwise.operators import quality as Q
from wardwise.operators.profile import category_counts
from wardwise.plans import fragments as X
from wardwise.plans.registry import register

# --- cohorts and joins ------------------------------------------------------------------------
register("index_admissions", lambda c: H.index_admissions(c.encounters),
         f"WITH {X.FIRST} SELECT * FROM firsts")
register("exclude_dispositions",
         lambda c: H.exclude_dispositions(H.index_admissions(c.encounters)),
         f"WITH {X.COHORT} SELECT * FROM cohort")
register("index_cohort", lambda c: H.index_cohort(c), f"""
WITH {X.MERGED}, ranked AS (SELECT * FROM merged
  QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1)
SELECT * FROM ranked WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""")

_ANY = " OR ".join(f"COALESCE(starts_with(trim({d}), '250'), FALSE)" for d in K.DIAGNOSIS_COLUMNS)
_ONE = "COALESCE(starts_with(trim(diag_1), '250'), FALSE)"
register("diabetes_any", lambda c: H.diabetes_any(c.encounters),
         f"SELECT * FROM {{encounters}} WHERE {_ANY}")
register("diabetes_primary", lambda c: H.diabetes_primary(c.encounters),
         f"SELECT * FROM {{encounters}} WHERE {_ONE}")
register("diabetes_share", lambda c: H.diabetes_share(c.encounters), f"""
SELECT 'any' AS cohort, COUNT(*) FILTER (WHERE {_ANY}) AS encounters, COUNT(*) AS total,
  CAST(COUNT(*) FILTER (WHERE {_ANY}) AS DOUBLE) / COUNT(*) AS share FROM {{encounters}}
UNION ALL SELECT 'primary', COUNT(*) FILTER (WHERE {_ONE}), COUNT(*),
  CAST(COUNT(*) FILTER (WHERE {_ONE}) AS DOUBLE) / COUNT(*) FROM {{encounters}}""")


def _levelled(c):
    return c.encounters.withColumn("comorbidity", C.comorbidity_level(F.col("number_diagnoses")))


for _k in (1, 2):
    register(f"comorbidity_cohort_{_k}",
             lambda c, k=_k: H.comorbidity_cohort(_levelled(c), k).select("encounter_id",
                                                                         "comorbidity"),
             f"SELECT encounter_id, {X.LEVEL} AS comorbidity FROM {{encounters}} "
             f"WHERE {X.LEVEL} = {_k}")

_MASK = ", ".join(
    f"CASE WHEN NOT COALESCE(starts_with(trim({d}), '250'), FALSE) THEN {d} END AS {d}, "
    f"CASE WHEN NOT COALESCE(starts_with(trim({d}), '250'), FALSE) THEN {X.icd9(d)} END"
    f" AS {d}_category" for d in K.DIAGNOSIS_COLUMNS)
register("mask_diabetes_diagnoses",
         lambda c: H.mask_diabetes_diagnoses(N.derive_features(c.encounters)).select(
             "encounter_id", *K.DIAGNOSIS_COLUMNS, *[f"{d}_category" for d in K.DIAGNOSIS_COLUMNS]),
         f"SELECT encounter_id, {_MASK} FROM {{encounters}}")
register("drop_columns",
         lambda c: H.drop_columns(c.encounters, *K.SPLIT_DROP_COLUMNS, "absent_column"),
         "SELECT * EXCLUDE (encounter_id, patient_nbr, admission_type_id, "
         "discharge_disposition_id, admission_source_id, readmitted) FROM {encounters}")
register("merge_codes",
         lambda c: H.merge_codes(c.encounters, c.admission_type, c.discharge_disposition,
                                 c.admission_source),
         f"WITH {X.MERGED} SELECT * FROM merged")
register("join_medications_patients",
         lambda c: c.medications.join(c.patients.select("patient_id", "readmitted"), "patient_id"),
         "SELECT m.*, p.readmitted FROM {medications} m JOIN {patients} p USING (patient_id)")
register("join_comorbidity_patients",
         lambda c: H.with_comorbidity_counts(c.encounters, "patient_nbr")
         .select("encounter_id", "patient_nbr", "readmitted", "n"), """
SELECT e.encounter_id, e.patient_nbr, e.readmitted, c.n
FROM {encounters} e LEFT JOIN (
  SELECT patient_nbr, COUNT(*) FILTER (WHERE code <> '?') AS n
  FROM (UNPIVOT (SELECT patient_nbr, diag_1, diag_2, diag_3 FROM {encounters})
        ON diag_1, diag_2, diag_3 INTO NAME place VALUE code) GROUP BY 1) c USING (patient_nbr)""")

# --- cleaning ---------------------------------------------------------------------------------
_TEXT = ["race", "gender", "age", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2",
         "diag_3", "metformin", "insulin", "change", "readmitted"]
_NULLED = ", ".join(f"NULLIF({n}, '?') AS {n}" for n in _TEXT)
register("replace_sentinel", lambda c: N.replace_sentinel(c.encounters),
         f"SELECT * REPLACE ({_NULLED}) FROM {{encounters}}")
register("drop_sparse_columns",
         lambda c: N.drop_sparse_columns(N.replace_sentinel(c.encounters)),
         f"SELECT * EXCLUDE (weight) REPLACE "
         f"({', '.join(f'NULLIF({n}, {chr(39)}?{chr(39)}) AS {n}' for n in _TEXT if n != 'weight')})"
         f" FROM {{encounters}}")
_FILLED = {"race", "payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3"}
_CLEAN = ", ".join(f"COALESCE(NULLIF({n}, '?'), 'Unknown') AS {n}" if n in _FILLED
                   else f"NULLIF({n}, '?') AS {n}" for n in _TEXT if n != "weight")
register("fill_unknown", lambda c: N.handle_missing(c.encounters),
         f"SELECT * EXCLUDE (weight) REPLACE ({_CLEAN}) FROM {{encounters}}")


def _gappy(c):
    """Patients with gaps in the numeric columns."""
    return c.patients.select(
        "patient_id", F.nullif("age", F.lit(35)).alias("age"),
        F.nullif("time_in_hospital", F.lit(3)).alias("time_in_hospital"),
        F.nullif("num_medications", F.lit(9)).alias("num_medications"),
        F.when(F.col("num_lab_procedures") > 12, F.col("num_lab_procedures"))
        .alias("num_lab_procedures"), "num_procedures",
        F.concat(F.lit(" "), F.col("race"), F.lit(" ")).alias("race"), "diag_1", "readmitted")


_GAPPY = """gappy AS (SELECT patient_id, NULLIF(age, 35) AS age,
  NULLIF(time_in_hospital, 3) AS time_in_hospital, NULLIF(num_medications, 9) AS num_medications,
  CASE WHEN num_lab_procedures > 12 THEN num_lab_procedures END AS num_lab_procedures,
  num_procedures, ' ' || race || ' ' AS race, diag_1, readmitted FROM {patients})"""
_MEDIAN = ", ".join(
    f"CAST(COALESCE({n}, (SELECT MEDIAN({n}) FROM gappy)) AS DOUBLE) AS {n}"
    for n in K.MEDIAN_COLUMNS)
register("median_impute", lambda c: N.median_impute(_gappy(c)),
         f"WITH {_GAPPY} SELECT * REPLACE ({_MEDIAN}) FROM gappy")
register("coerce_types",
         lambda c: N.coerce_types(c.encounters.select(
             "encounter_id", "age", F.col("diag_1").alias("time_in_hospital"), "num_medications",
             "num_lab_procedures")), """
SELECT encounter_id, TRY_CAST(age AS INT) AS age,
  CAST(trunc(TRY_CAST(diag_1 AS DOUBLE)) AS INT) AS time_in_hospital, num_medications,
  num_lab_procedures FROM {encounters}""")
register("trim_strings", lambda c: N.trim_strings(_gappy(c).select("patient_id", "race")),
         f"WITH {_GAPPY} SELECT patient_id, trim(race) AS race FROM gappy")
register("stamp_created_at",
         lambda c: N.stamp_created_at(c.encounters.select("encounter_id")))
register("reorder_columns", lambda c: N.reorder_columns(N.derive_features(c.encounters)), f"""
SELECT *, {X.MIDPOINT} AS age_midpoint, {X.AGE_GROUP} AS age_group, {X.icd9('diag_1')} AS diag_1_category,
  {X.icd9('diag_2')} AS diag_2_category, {X.icd9('diag_3')} AS diag_3_category, {X.LEVEL} AS comorbidity FROM {{encounters}}""")
_INTS = ", ".join(
    f"CAST(trunc(COALESCE({n}, (SELECT MEDIAN({n}) FROM gappy))) AS INT) AS {n}"
    for n in K.MEDIAN_COLUMNS)
register("transform_patients", lambda c: N.transform_patients(_gappy(c), stamp=False), f"""
WITH {_GAPPY} SELECT * REPLACE ({_INTS}, trim(race) AS race, trim(NULLIF(diag_1, '?')) AS diag_1)
FROM gappy""")
register("transform_medications",
         lambda c: N.transform_medications(c.medications.withColumn(
             "medication_name", F.concat(F.lit("  "), F.col("medication_name"))), stamp=False),
         "SELECT patient_id, trim(medication_name) AS medication_name, dosage_change "
         "FROM {medications}")

# --- derived features -------------------------------------------------------------------------


def feature(name, expression, sql, view="encounters", key="encounter_id"):
    register(name, lambda c: getattr(c, view).select(key, expression().alias("value")),
             f"SELECT {key}, {sql} AS value FROM {{{view}}}")


feature("icd9_category", lambda: C.icd9_category(F.col("diag_1")), X.icd9("diag_1"))
feature("icd9_category_half_open", lambda: C.icd9_category(F.col("diag_2"), False),
        X.icd9("diag_2", False))
feature("age_midpoint", lambda: C.age_midpoint(F.col("age")), X.MIDPOINT)
feature("age_midpoint_compat", lambda: C.age_midpoint(F.col("age"), compat=True),
        X.MIDPOINT_COMPAT)
feature("age_group", lambda: C.age_group(F.col("age")), X.AGE_GROUP)
feature("bin_age", lambda: C.bin_age(F.col("age")), """
  CASE WHEN age >= 0 AND age < 30 THEN '<30' WHEN age >= 30 AND age < 40 THEN '30-39'
    WHEN age >= 40 AND age < 50 THEN '40-49' WHEN age >= 50 AND age < 60 THEN '50-59'
    WHEN age >= 60 AND age < 70 THEN '60-69' WHEN age >= 70 AND age < 80 THEN '70-79'
    WHEN age >= 80 AND age < 100 THEN '80+' END""", "patients", "patient_id")
feature("bin_age_decades", lambda: C.bin_age(F.col("age"), K.AGE_BINS_10), """
  CASE WHEN age >= 0 AND age < 100
    THEN (10 * (age // 10)) || '-' || (10 * (age // 10) + 10) END""", "patients", "patient_id")
feature("comorbidity_level", lambda: C.comorbidity_level(F.col("number_diagnoses")), X.LEVEL)
feature("categorize_disease", lambda: C.categorize_disease(F.nullif("diag_1", F.lit("?"))),
        X.disease("NULLIF(diag_1, '?')"))
register("dominant_category",
         lambda c: c.encounters.select("encounter_id", C.dominant(
             *[C.categorize_disease(F.col(d)) for d in K.DIAGNOSIS_COLUMNS]).alias("value")),
         f"WITH {X.DOMINANT} SELECT encounter_id, comorbidity_group AS value FROM grouped")
feature("normalize_icd9", lambda: C.normalize_icd9(F.col("diag_3")), X.normalized("diag_3"))
feature("diagnosis_label", lambda: C.diagnosis_label(C.normalize_icd9(F.col("diag_1"))),
        X.label(f"({X.normalized('diag_1')})"))

_CCS_SQL = " ".join(f"WHEN regexp_matches(lower(descr), '{'|'.join(words)}') THEN '{name}'"
                    for name, words in K.CCS_KEYWORDS)


def _described(c):
    """Disease group and diagnosis label of an encounter as its description text."""
    return c.encounters.select("encounter_id", F.concat_ws(
        " / ", C.categorize_disease(F.col("diag_1")),
        C.diagnosis_label(C.normalize_icd9(F.col("diag_2"))),
        C.icd9_category(F.col("diag_3"))).alias("descr"))


register("ccs_category",
         lambda c: _described(c).select("encounter_id", C.ccs_category(F.col("descr")).alias("value")),
         f"""WITH described AS (SELECT encounter_id, {X.disease('diag_1')} || ' / '
  || {X.label(f"({X.normalized('diag_2')})")} || ' / ' || {X.icd9('diag_3')} AS descr
  FROM {{encounters}})
SELECT encounter_id, CASE {_CCS_SQL} ELSE 'other' END AS value FROM described""")
feature("dose_change", lambda: C.dose_change(F.col("insulin")), X.DOSE.format("insulin"))
register("icu_flag",
         lambda c: c.encounters.join(c.admission_source, "admission_source_id", "left").select(
             "encounter_id", C.icu_flag(F.col("admission_source_desc")).alias("value")), """
SELECT encounter_id, CASE WHEN regexp_matches(lower(admission_source_desc),
  'emergency room|transfer from critical access hospital|transfer from a hospital')
  THEN 1 ELSE 0 END AS value
FROM {encounters} e LEFT JOIN {admission_source} s USING (admission_source_id)""")
feature("encode_target_binary", lambda: C.encode_target(F.col("readmitted")), X.TARGET)
feature("encode_target_multiclass", lambda: C.encode_target(F.col("readmitted"), "multiclass"),
        X.CODE3)
feature("encode_target_risk", lambda: C.encode_target(F.col("readmitted"), "risk_level"),
        "CASE readmitted WHEN 'NO' THEN 0 WHEN '>30' THEN 1 WHEN '<30' THEN 3 END")
feature("readmit_bin", lambda: C.readmit_bin(F.col("readmitted")),
        "CASE WHEN readmitted = '<30' THEN 'Early Readmission' ELSE 'No Early Readmission' END")
feature("stay_category", lambda: C.stay_category(F.col("time_in_hospital")), """
  CASE WHEN time_in_hospital <= 3 THEN 'Short Stay (1-3 days)'
    WHEN time_in_hospital <= 7 THEN 'Medium Stay (4-7 days)'
    WHEN time_in_hospital <= 14 THEN 'Long Stay (8-14 days)'
    ELSE 'Extended Stay (15+ days)' END""")
feature("comorbidity_count",
        lambda: C.comorbidity_count(*[F.col(d) for d in K.DIAGNOSIS_COLUMNS]), """
  CAST(diag_1 <> '?' AS INT) + CAST(diag_2 <> '?' AS INT) + CAST(diag_3 <> '?' AS INT)""")


def _feature_names(c):
    """One-hot style names of category values, and the plain column names."""
    columns = ["race", "gender", "payer_code", "change", "metformin", "insulin", "diag_1", "weight"]
    named = category_counts(c.encounters, columns)
    return (named.select(F.concat_ws("_", "column", "value").alias("feature"))
            .unionByName(named.select(F.col("column").alias("feature")).distinct()))


_OWNERS = [(f, cat) for cat, fs in K.FEATURE_CATEGORIES.items() for f in fs]
_VALUES = ", ".join(f"('{f}', '{cat}', {i})" for i, (f, cat) in enumerate(_OWNERS))
_STACK = " UNION ".join(
    part for n in ["race", "gender", "payer_code", "change", "metformin", "insulin", "diag_1",
                   "weight"]
    for part in (f"SELECT '{n}_' || {n} AS feature FROM {{encounters}}", f"SELECT '{n}'"))
register("categorise_features",
         lambda c: _feature_names(c).select(
             "feature", C.feature_category(F.col("feature")).alias("category")), f"""
WITH owners(base, category, pos) AS (VALUES {_VALUES}), names AS ({_STACK})
SELECT feature, COALESCE(
  (SELECT category FROM owners o WHERE o.base = n.feature),
  (SELECT arg_min(category, pos) FROM owners o WHERE starts_with(n.feature, o.base || '_')),
  'Unknown') AS category
FROM names n""")

# --- quality ----------------------------------------------------------------------------------
_P = ["patient_id", "age", "gender", "race", "time_in_hospital", "diag_1", "readmitted"]


def _with_bad_values(c):
    """Patients with some unknown classes, as a dirty load has them."""
    odd = F.when(F.col("age") == 95, F.concat(F.lit("?"), F.col("race"), F.lit("/"), F.col("num_procedures"))).otherwise(
        F.col("readmitted"))
    return c.patients.withColumn("readmitted", odd).select(*_P)


_BAD = """dirty AS (SELECT patient_id, age, gender, race, time_in_hospital, diag_1,
  CASE WHEN age = 95 THEN '?' || race || '/' || num_procedures ELSE readmitted END AS readmitted FROM {patients})"""
_NULLS = ", ".join(f"COUNT(*) FILTER (WHERE {n} IS NULL) AS null_{n}" for n in _P)
register("validate_patients", lambda c: Q.validate_patients(_with_bad_values(c)), f"""
WITH {_BAD}, bad AS (SELECT DISTINCT COALESCE(readmitted, '(null)') AS v FROM dirty
  WHERE readmitted IS NULL OR readmitted NOT IN ('<30', '>30', 'NO'))
SELECT COUNT(*) AS total_rows, {_NULLS}, MIN(age) AS min_age, MAX(age) AS max_age,
  MIN(time_in_hospital) AS min_time_in_hospital, MAX(time_in_hospital) AS max_time_in_hospital,
  (SELECT COUNT(*) FROM bad) AS invalid_readmitted,
  MIN(age) >= 0 AND MAX(age) <= 120 AS age_in_range,
  MIN(time_in_hospital) >= 1 AND MAX(time_in_hospital) <= 365 AS stay_in_range,
  COUNT(*) FILTER (WHERE patient_id IS NULL) = 0 AND (SELECT COUNT(*) FROM bad) = 0 AS is_valid
FROM dirty""")
register("invalid_readmitted", lambda c: Q.invalid_readmitted(_with_bad_values(c)), f"""
WITH {_BAD} SELECT COALESCE(readmitted, '(null)') AS value, COUNT(*) AS n FROM dirty
WHERE readmitted IS NULL OR readmitted NOT IN ('<30', '>30', 'NO') GROUP BY 1""")
register("validate_medications", lambda c: Q.validate_medications(c.medications), """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE patient_id IS NULL) AS null_patient_id,
  COUNT(*) FILTER (WHERE medication_name IS NULL) AS null_medication_name,
  COUNT(*) FILTER (WHERE dosage_change IS NULL) AS null_dosage_change,
  COUNT(DISTINCT medication_name) AS distinct_medications,
  COUNT(DISTINCT medication_name) > 0 AS names_consistent,
  COUNT(*) FILTER (WHERE patient_id IS NULL) = 0 AS is_valid
FROM {medications}""")


def _tables(c):
    return {"patients": c.patients,
            "encounters": c.encounters.withColumn("patient_id", F.col("patient_nbr").cast("string")),
            "medications": c.medications, "model_results": c.model_results}


register("key_checks",
         lambda c: Q.key_checks(_tables(c), {"patients": "patient_id", "encounters": "encounter_id",
                                             "model_results": "id"},
                                [("medications", "patients", "patient_id"),
                                 ("encounters", "patients", "patient_id")]), """
SELECT 'primary:patients.patient_id' AS "check", COUNT(*) AS violations FROM
  (SELECT patient_id FROM {patients} GROUP BY 1 HAVING COUNT(*) > 1 OR patient_id IS NULL)
UNION ALL SELECT 'primary:encounters.encounter_id', COUNT(*) FROM
  (SELECT encounter_id FROM {encounters} GROUP BY 1 HAVING COUNT(*) > 1 OR encounter_id IS NULL)
UNION ALL SELECT 'primary:model_results.id', COUNT(*) FROM
  (SELECT id FROM {model_results} GROUP BY 1 HAVING COUNT(*) > 1 OR id IS NULL)
UNION ALL SELECT 'foreign:medications.patient_id->patients', COUNT(DISTINCT patient_id)
  FROM {medications} WHERE patient_id NOT IN (SELECT patient_id FROM {patients})
UNION ALL SELECT 'foreign:encounters.patient_id->patients', COUNT(DISTINCT patient_nbr)
  FROM {encounters} WHERE CAST(patient_nbr AS VARCHAR) NOT IN (SELECT patient_id FROM {patients})
""")
register("medications_long", lambda c: Q.medications_long(c.encounters),
         "SELECT * FROM {medications}")
