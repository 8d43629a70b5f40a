"""Queries of the SQL analytics suite."""

from pyspark.sql import functions as F

from wardwise.operators import suite as S
from wardwise.plans.registry import register

EARLY = "COUNT(*) FILTER (WHERE readmitted = '<30')"
LATE = "COUNT(*) FILTER (WHERE readmitted = '>30')"
NEVER = "COUNT(*) FILTER (WHERE readmitted = 'NO')"
RATE = f"ROUND(CAST({EARLY} AS DOUBLE) * 100.0 / COUNT(*), 2)"
ANY_RATE = ("ROUND(CAST(COUNT(*) FILTER (WHERE readmitted IN ('<30', '>30')) AS DOUBLE)"
            " * 100.0 / COUNT(*), 2)")
STAY_NAME = """CASE WHEN time_in_hospital <= 3 THEN 'Short Stay (1-3 days)'
  WHEN time_in_hospital <= 7 THEN 'Medium Stay (4-7 days)'
  WHEN time_in_hospital <= 14 THEN 'Long Stay (8-14 days)' ELSE 'Extended Stay (15+ days)' END"""
SCORE = """CASE WHEN num_medications > 10 THEN 1 ELSE 0 END
  + CASE WHEN time_in_hospital > 7 THEN 1 ELSE 0 END
  + CASE WHEN num_lab_procedures > 20 THEN 1 ELSE 0 END"""
AS_OF = "2024-01-25"
HISTORY_ID = "77"

register("demographics", lambda c: S.demographics(c.patients), f"""
SELECT age, gender, race, COUNT(*) AS patient_count, AVG(time_in_hospital) AS avg_length_of_stay,
  {EARLY} AS early_readmissions, {LATE} AS late_readmissions, {NEVER} AS no_readmissions,
  {ANY_RATE} AS overall_readmission_rate
FROM {{patients}} GROUP BY age, gender, race ORDER BY age, gender, race""")

register("readmission_stats", lambda c: S.readmission_stats(c.patients), f"""
SELECT age, gender, COUNT(*) AS total_patients, {EARLY} AS early_readmissions,
  {LATE} AS late_readmissions, {NEVER} AS no_readmissions, {RATE} AS early_readmission_rate
FROM {{patients}} GROUP BY age, gender ORDER BY age, gender""")

register("risk_factors", lambda c: S.risk_factors(c.patients), f"""
SELECT admission_type_id, discharge_disposition_id, admission_source_id,
  COUNT(*) AS total_cases, {EARLY} AS early_readmissions, {RATE} AS early_readmission_rate,
  AVG(time_in_hospital) AS avg_length_of_stay, AVG(num_medications) AS avg_medications,
  AVG(num_lab_procedures) AS avg_lab_procedures
FROM {{patients}} GROUP BY ALL ORDER BY early_readmission_rate DESC""")

register("diagnosis_analysis", lambda c: S.diagnosis_analysis(c.patients), f"""
SELECT diag_1, COUNT(*) AS diagnosis_count, {EARLY} AS early_readmissions,
  {LATE} AS late_readmissions, {NEVER} AS no_readmissions, {RATE} AS early_readmission_rate,
  AVG(time_in_hospital) AS avg_length_of_stay
FROM {{patients}} WHERE diag_1 IS NOT NULL AND diag_1 <> '?'
GROUP BY diag_1 HAVING COUNT(*) >= 10
ORDER BY early_readmission_rate DESC, diag_1 LIMIT 20""")

# One row per drug and patient first, with its prescriptions and the patient's early stays.
_IMPACT = """
WITH stays AS (SELECT patient_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE readmitted = '<30') AS early
  FROM {{patients}} GROUP BY 1),
uses AS (SELECT medication_name, patient_id, COUNT(*) AS times FROM {{medications}} GROUP BY 1, 2),
drugs AS (SELECT medication_name, COUNT(*) AS users, CAST(SUM(times * early) AS BIGINT) AS early
  FROM uses SEMI JOIN stays USING (patient_id) JOIN stays USING (patient_id) GROUP BY 1)
SELECT medication_name, users AS patients_on_medication, {whole} AS total_patients,
  ROUND(100.0 * users / CAST({whole} AS DOUBLE), 2) AS medication_usage_rate,
  early AS early_readmissions, ROUND(CAST(early AS DOUBLE) * 100.0 / users, 2) AS readmission_rate_with_medication
FROM drugs WHERE users >= 5"""
register("medication_impact", lambda c: S.medication_impact(c.medications, c.patients),
         _IMPACT.format(whole="users"))
register("medication_impact_all",
         lambda c: S.medication_impact(c.medications, c.patients, against_all=True),
         _IMPACT.format(whole="(SELECT COUNT(DISTINCT patient_id) FROM {patients})"))

register("length_of_stay", lambda c: S.length_of_stay(c.patients), f"""
SELECT {STAY_NAME} AS stay_category, COUNT(*) AS patient_count, {EARLY} AS early_readmissions,
  {LATE} AS late_readmissions, {NEVER} AS no_readmissions, {RATE} AS early_readmission_rate,
  AVG(time_in_hospital) AS avg_length_of_stay
FROM {{patients}} GROUP BY 1 ORDER BY avg_length_of_stay""")

register("comorbidity_analysis", lambda c: S.comorbidity_analysis(c.patients), f"""
WITH codes AS (SELECT patient_id, code FROM (
    UNPIVOT (SELECT patient_id, diag_1, diag_2, diag_3 FROM {{patients}}) ON diag_1, diag_2, diag_3 INTO NAME place VALUE code)),
held AS (SELECT patient_id, least(COUNT(*), 3) AS n FROM codes WHERE code <> '?' GROUP BY 1),
names(n, comorbidity_category) AS (VALUES (0, 'No Comorbidities'), (1, 'Single Comorbidity'),
  (2, 'Two Comorbidities'), (3, 'Multiple Comorbidities (3+)')),
named AS (SELECT p.*, comorbidity_category FROM {{patients}} p LEFT JOIN held USING (patient_id)
  JOIN names ON names.n = COALESCE(held.n, 0))
SELECT comorbidity_category, COUNT(*) AS patient_count, {EARLY} AS early_readmissions,
  {RATE} AS early_readmission_rate, AVG(time_in_hospital) AS avg_length_of_stay, AVG(num_medications) AS avg_medications
FROM named GROUP BY 1""")

register("operational_metrics", lambda c: S.operational_metrics(c.patients), f"""
SELECT COUNT(*) AS total_patients, AVG(time_in_hospital) AS avg_length_of_stay,
  {EARLY} AS early_readmissions, {LATE} AS late_readmissions,
  {ANY_RATE} AS overall_readmission_rate, {RATE} AS early_readmission_rate,
  AVG(num_medications) AS avg_medications_per_patient,
  AVG(num_lab_procedures) AS avg_lab_procedures_per_patient,
  COUNT(DISTINCT diag_1) AS unique_primary_diagnoses
FROM {{patients}}""")

_AVGS = ", ".join(f"ROUND(AVG({m}), 9) AS avg_{m}" for m in S._METRICS)


def rounded(df, digits=9):
    """Round the floating columns, so that the order of summation does not show."""
    return df.select(*[F.round(f"`{n}`", digits).alias(n) if t == "double" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


register("model_trends",
         lambda c: rounded(S.model_trends(c.model_results, F.to_date(F.lit(AS_OF)))), f"""
SELECT CAST(created_at AS DATE) AS run_date, model_name, feature_selection_method,
  top_n_features, {_AVGS}, COUNT(*) AS runs_count
FROM {{model_results}} WHERE created_at >= DATE '{AS_OF}' - INTERVAL 30 DAYS
GROUP BY 1, 2, 3, 4 ORDER BY run_date DESC, avg_auc_score DESC""")

register("best_models", lambda c: S.best_models(c.model_results), """
WITH ranked AS (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY auc_score DESC NULLS FIRST, id) AS by_auc,
  ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY f1_score DESC NULLS FIRST, id) AS by_f1
  FROM {model_results})
SELECT model_name, feature_selection_method, top_n_features, accuracy, precision, recall,
  f1_score, auc_score, created_at
FROM ranked WHERE by_auc = 1 OR by_f1 = 1 ORDER BY auc_score DESC, f1_score DESC""")

register("feature_selection_analysis",
         lambda c: rounded(S.feature_selection_analysis(c.model_results)), """
SELECT feature_selection_method, top_n_features, COUNT(*) AS model_runs,
  ROUND(AVG(auc_score), 9) AS avg_auc_score, ROUND(STDDEV_SAMP(auc_score), 9) AS auc_std_dev,
  ROUND(AVG(f1_score), 9) AS avg_f1_score, ROUND(STDDEV_SAMP(f1_score), 9) AS f1_std_dev,
  MIN(auc_score) AS min_auc_score, MAX(auc_score) AS max_auc_score
FROM {model_results} GROUP BY 1, 2 ORDER BY avg_auc_score DESC, avg_f1_score DESC""")

register("model_performance_summary",
         lambda c: rounded(S.model_performance_summary(c.model_results)), f"""
SELECT model_name, feature_selection_method, top_n_features, {_AVGS}, COUNT(*) AS num_runs
FROM {{model_results}} GROUP BY 1, 2, 3 ORDER BY avg_auc_score DESC""")

_SUMMARY = """
SELECT 'total' AS section, 'patients' AS item, CAST(COUNT(*) AS DOUBLE) AS value FROM {patients}
UNION ALL SELECT 'readmission_distribution', COALESCE(readmitted, '(null)'),
  CAST(COUNT(*) AS DOUBLE) FROM {patients} GROUP BY readmitted
UNION ALL SELECT 'gender_distribution', COALESCE(gender, '(null)'), CAST(COUNT(*) AS DOUBLE)
  FROM {patients} GROUP BY gender
UNION ALL SELECT 'age_statistics', 'min_age', CAST(MIN(age) AS DOUBLE) FROM {patients}
UNION ALL SELECT 'age_statistics', 'max_age', CAST(MAX(age) AS DOUBLE) FROM {patients}
UNION ALL SELECT 'age_statistics', 'avg_age', ROUND(AVG(age), 9) FROM {patients}
UNION ALL SELECT 'age_statistics', 'std_age', ROUND(STDDEV_SAMP(age), 9) FROM {patients}"""
register("data_summary", lambda c: rounded(S.data_summary(c.patients)), _SUMMARY)

register("patient_history", lambda c: S.patient_history(c.patients, HISTORY_ID), f"""
SELECT patient_id, age, gender, race, admission_type_id, discharge_disposition_id,
  time_in_hospital, num_medications, num_lab_procedures, diag_1, diag_2, diag_3, readmitted,
  created_at AS encounter_date
FROM {{patients}} WHERE patient_id = '{HISTORY_ID}' ORDER BY created_at DESC""")

register("high_risk_patients", lambda c: S.high_risk_patients(c.patients), f"""
SELECT patient_id, age, gender, time_in_hospital, num_medications, num_lab_procedures, diag_1,
  diag_2, diag_3, readmitted, {SCORE} AS risk_score
FROM {{patients}} WHERE {SCORE} >= 0.3 ORDER BY risk_score DESC, num_medications DESC""")


def _bundle(c):
    """The rows of every result set of the bundle."""
    parts = {**S.analytics_bundle(c.patients, c.medications, c.model_results,
                                  F.to_date(F.lit(AS_OF))),
             **S.summary_bundle(c.patients, c.model_results)}
    out = None
    for name, df in parts.items():
        cells = F.concat_ws("|", *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in df.columns])
        part = rounded(df).select(F.lit(name).alias("result_set"), cells.alias("cells"))
        out = part if out is None else out.unionByName(part)
    return out


register("analytics_bundle", _bundle)
