"""Queries of profiles, rate tables, ordered windows and statistics."""

from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators import cleaning as N
from wardwise.operators import ordered as O
from wardwise.operators import profile as P
from wardwise.operators import rates as R
from wardwise.operators import stats as T
from wardwise.plans import fragments as X
from wardwise.plans.registry import register
from wardwise.plans.suite_queries import rounded

CATEGORICAL = ["race", "gender", "payer_code", "medical_specialty", "change", "readmitted"]
COUNTS = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
          "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses"]
TEXT = ["race", "gender", "age", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2",
        "diag_3", "metformin", "insulin", "change", "readmitted"]
ALL = ["encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id",
       "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code",
       "medical_specialty", "num_lab_procedures", "num_procedures", "num_medications",
       "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
       "number_diagnoses", "metformin", "insulin", "change", "readmitted", "created_at"]


def union_sql(parts):
    return "\nUNION ALL ".join(parts)


# --- counts and profiles ----------------------------------------------------------------------
register("value_counts", lambda c: P.value_counts(c.encounters, "readmitted"),
         "SELECT readmitted AS value, COUNT(*) AS n FROM {encounters} GROUP BY 1")
register("category_counts", lambda c: P.category_counts(c.encounters, CATEGORICAL),
         union_sql(f"SELECT '{n}' AS \"column\", {n} AS value, COUNT(*) AS n FROM {{encounters}} "
                   f"GROUP BY {n}" for n in CATEGORICAL))


def _nulled(c):
    return N.replace_sentinel(c.encounters)


_NULLED = ("nulled AS (SELECT * REPLACE (" + ", ".join(f"NULLIF({n}, '?') AS {n}" for n in TEXT)
           + ") FROM {encounters})")
_MISSING = union_sql(
    f"SELECT '{n}' AS \"column\", COUNT(*) FILTER (WHERE {n} IS NULL) AS missing_count, "
    f"CAST(COUNT(*) FILTER (WHERE {n} IS NULL) AS DOUBLE) * 100.0 / COUNT(*) AS missing_percentage"
    f" FROM nulled" for n in ALL)
register("missing_profile", lambda c: P.missing_profile(_nulled(c)), f"WITH {_NULLED} {_MISSING}")
register("data_info", lambda c: P.data_info(_nulled(c)),
         f"""WITH {_NULLED}, m AS ({_MISSING}), one AS (SELECT * FROM nulled LIMIT 1),
t AS ({union_sql(f"SELECT '{n}' AS name, lower(typeof({n})) AS kind FROM one" for n in ALL)})
SELECT m.*, {len(ALL)} AS n_columns, CASE t.kind WHEN 'integer' THEN 'int' WHEN 'varchar' THEN 'string' WHEN 'timestamp' THEN 'timestamp_ntz' ELSE t.kind END AS dtype
FROM m JOIN t ON t.name = m."column\"""")
register("sentinel_profile", lambda c: P.sentinel_profile(c.encounters),
         "SELECT * FROM (" + union_sql(
             f"SELECT '{n}' AS \"column\", COUNT(*) FILTER (WHERE {n} = '?') AS sentinel_count, "
             f"CAST(COUNT(*) FILTER (WHERE {n} = '?') AS DOUBLE) * 100.0 / COUNT(*) "
             f"AS sentinel_percentage FROM {{encounters}}" for n in TEXT)
         + ") WHERE sentinel_count > 0")
_FILL = ", ".join(f"'{n}'" for n in ["medical_specialty", "payer_code", "race", "diag_1", "diag_2",
                                     "diag_3"])
register("missing_decisions", lambda c: P.missing_decisions(c.encounters), f"""
WITH {_NULLED}, m AS ({_MISSING})
SELECT "column", missing_percentage, CASE WHEN missing_percentage > 50 THEN 'drop'
  WHEN "column" IN ({_FILL}) THEN 'fill Unknown' ELSE 'keep' END AS action
FROM m WHERE missing_count > 0""")
register("duplicate_count",  # every seventh encounter comes twice, all columns are compared
         lambda c: P.duplicate_count(c.encounters.union(c.encounters.filter("encounter_id % 7 = 0"))),
         "WITH twice AS (SELECT * FROM {encounters} UNION ALL SELECT * FROM {encounters} "
         "WHERE encounter_id % 7 = 0) SELECT (SELECT COUNT(*) FROM twice) - (SELECT COUNT(*) FROM "
         "(SELECT DISTINCT * FROM twice)) AS duplicate_rows")
register("distinct_patients", lambda c: P.distinct_patients(c.encounters),
         "SELECT COUNT(DISTINCT patient_nbr) AS patients FROM {encounters}")
register("average_age", lambda c: P.average_age(c.encounters),
         f"SELECT AVG({X.MIDPOINT}) AS average_age FROM {{encounters}}")
_HIST = ["num_lab_procedures", "num_medications", "time_in_hospital"]


def hist_sql(source, columns, bins):
    return union_sql(f"""
SELECT '{n}' AS "column", g.bin, s.lo + g.bin * s.w AS low, s.lo + (g.bin + 1) * s.w AS high,
  (SELECT COUNT(*) FROM {source} WHERE {n} IS NOT NULL AND least(CAST(floor((CAST({n} AS DOUBLE)
    - s.lo) / s.w) AS INT), {bins - 1}) = g.bin) AS n
FROM (SELECT CAST(MIN({n}) AS DOUBLE) AS lo, (CAST(MAX({n}) AS DOUBLE) - CAST(MIN({n}) AS DOUBLE))
  / {bins} AS w FROM {source}) s, (SELECT CAST(range AS INT) AS bin FROM range({bins})) g"""
                     for n in columns)


register("histogram", lambda c: P.histogram(c.encounters, _HIST, 10),
         hist_sql("{encounters}", _HIST, 10))
register("probability_histogram", lambda c: P.histogram(c.scored, ["probability"], 50),
         hist_sql("{scored}", ["probability"], 50))
register("crosstab",
         lambda c: P.crosstab(c.encounters, "admission_type_id", "readmitted",
                              K.READMITTED_VALUES), """
SELECT admission_type_id AS row, COUNT(*) FILTER (WHERE readmitted = '<30') AS "<30",
  COUNT(*) FILTER (WHERE readmitted = '>30') AS ">30",
  COUNT(*) FILTER (WHERE readmitted = 'NO') AS "NO" FROM {encounters} GROUP BY 1""")
_DESCRIBED = [n for n in ALL if n.endswith("_id") or n.startswith(("num", "time", "patient"))]
register("describe_columns", lambda c: rounded(P.describe_columns(c.encounters), 6),
         union_sql(f"""
SELECT '{n}' AS "column", COUNT({n}) AS count, ROUND(AVG({n}), 6) AS mean,
  ROUND(STDDEV_SAMP({n}), 6) AS std, CAST(MIN({n}) AS DOUBLE) AS min,
  quantile_cont(CAST({n} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({n} AS DOUBLE), 0.5) AS q50,
  quantile_cont(CAST({n} AS DOUBLE), 0.75) AS q75, CAST(MAX({n}) AS DOUBLE) AS max
FROM {{encounters}}""" for n in _DESCRIBED))
register("head", lambda c: P.head(c.encounters.orderBy("encounter_id")),
         "SELECT * FROM {encounters} ORDER BY encounter_id LIMIT 5")

# --- rates ------------------------------------------------------------------------------------
register("avg_stay_by_age", lambda c: R.avg_stay_by_age(c.encounters),
         f"SELECT {X.AGE_GROUP} AS age_group, AVG(time_in_hospital) AS avg_stay "
         "FROM {encounters} GROUP BY 1")
register("stay_quartiles_by_age_gender",
         lambda c: R.stay_quartiles_by_age_gender(c.encounters), f"""
WITH rows AS (SELECT {X.AGE_GROUP} AS age_group, gender, CAST(time_in_hospital AS DOUBLE) AS v
  FROM {{encounters}}),
box AS (SELECT age_group, gender, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM rows GROUP BY 1, 2)
SELECT r.age_group, r.gender, COUNT(*) AS n, ANY_VALUE(q1) AS q1, ANY_VALUE(median) AS median,
  ANY_VALUE(q3) AS q3,
  MIN(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  MAX(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  COUNT(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM rows r JOIN box b ON r.age_group = b.age_group AND r.gender = b.gender GROUP BY 1, 2""")
register("top_diagnoses", lambda c: R.top_diagnoses(c.encounters),
         f"WITH codes AS ({X.STACKED}) SELECT code, COUNT(*) AS n FROM codes GROUP BY 1 "
         "ORDER BY n DESC, code LIMIT 10")
register("top_diagnoses_normalized",
         lambda c: R.top_diagnoses(c.encounters, 20, normalized=True), f"""
WITH codes AS ({X.STACKED}), clean AS (SELECT {X.normalized('code')} AS code FROM codes),
top AS (SELECT code, COUNT(*) AS n FROM clean GROUP BY 1 ORDER BY n DESC, code LIMIT 20)
SELECT code, n, {X.label('code')} AS label FROM top""")
register("stack_diagnoses", lambda c: R.stacked_diagnoses(c.encounters), X.STACKED)

_CLASS = "CAST(COUNT(*) FILTER (WHERE readmitted = '{0}') AS DOUBLE) * 100.0 / COUNT(*)"
_READMITTED = (f"shares AS (SELECT {X.AGE_GROUP} AS age_group, gender, "
               f"{_CLASS.format('<30')} AS early, {_CLASS.format('>30')} AS late "
               "FROM {encounters} WHERE readmitted <> 'NO' GROUP BY 1, 2)")
register("rate_by_age_gender", lambda c: R.rate_by_age_gender(c.encounters), f"""
WITH {_READMITTED} SELECT age_group, gender, '<30' AS readmitted, early AS percentage FROM shares
UNION ALL SELECT age_group, gender, '>30', late FROM shares""")
register("rate_by_age_gender_wide",
         lambda c: R.rate_by_age_gender_wide(c.encounters, ["Female", "Male"]), f"""
WITH {_READMITTED} SELECT age_group,
  MAX(early) FILTER (WHERE gender = 'Female') AS "Female <30",
  MAX(late) FILTER (WHERE gender = 'Female') AS "Female >30",
  MAX(early) FILTER (WHERE gender = 'Male') AS "Male <30",
  MAX(late) FILTER (WHERE gender = 'Male') AS "Male >30" FROM shares GROUP BY 1""")
_EARLY = _CLASS.format("<30")
register("early_rate_by_age_gender", lambda c: R.early_rate_by_age_gender(c.encounters), f"""
SELECT {X.AGE_GROUP} AS age_group, gender, {_EARLY} AS early_rate, 100.0 - {_EARLY} AS no_early_rate
FROM {{encounters}} GROUP BY 1, 2""")
register("early_rate_long", lambda c: R.early_rate_long(c.encounters), f"""
WITH r AS (SELECT {X.AGE_GROUP} AS age_group, gender, {_EARLY} AS e FROM {{encounters}} GROUP BY 1, 2)
SELECT age_group, gender, 'early_rate' AS measure, e AS percentage FROM r
UNION ALL SELECT age_group, gender, 'no_early_rate', 100.0 - e FROM r""")
_CELLS = ", ".join(
    f"CAST(COUNT(*) FILTER (WHERE gender = '{g}' AND readmitted {op} '<30') AS DOUBLE) * 100.0 "
    f"/ COUNT(*) AS \"{b}-{g}\""
    for b, op in (("Early Readmission", "="), ("No Early Readmission", "<>"))
    for g in ("Female", "Male"))
register("readmit_gender_matrix", lambda c: R.readmit_gender_matrix(c.encounters),
         f"SELECT {X.AGE_GROUP} AS age_group, {_CELLS} FROM {{encounters}} GROUP BY 1")
register("rate_by_comorbidity", lambda c: R.rate_by_comorbidity(c.encounters), f"""
WITH {X.DOMINANT} SELECT comorbidity_group, COUNT(*) AS patients, {_EARLY} AS early_rate,
  CAST(COUNT(*) FILTER (WHERE readmitted <> '<30') AS DOUBLE) * 100.0 / COUNT(*) AS no_early_rate
FROM grouped GROUP BY 1""")


def null_share(cls):
    n = f"COUNT(*) FILTER (WHERE readmitted = '{cls}')"
    return f"CAST(NULLIF({n}, 0) AS DOUBLE) * 100.0 / COUNT(*)"


register("rate_by_comorbidity_readmitted",
         lambda c: R.rate_by_comorbidity(c.encounters, readmitted=True), f"""
WITH {X.DOMINANT} SELECT comorbidity_group, {null_share('<30')} AS early_share,
  {null_share('>30')} AS late_share FROM grouped WHERE readmitted <> 'NO' GROUP BY 1""")
_DOSES = "doses AS (" + union_sql(
    f"SELECT '{d}' AS medication, {X.DOSE.format(d)} AS dose_change, readmitted "
    "FROM {encounters} WHERE readmitted <> 'NO'" for d in ("metformin", "insulin")) + ")"
_DOSE_RATE = (f"rates AS (SELECT medication, dose_change, NULLIF({null_share('<30')}, 100.0) "
              "AS early_share FROM doses GROUP BY 1, 2)")
register("rate_by_medication_dose", lambda c: R.rate_by_medication_dose(c.encounters),
         f"WITH {_DOSES}, {_DOSE_RATE} SELECT * FROM rates")
register("medication_dose_matrix", lambda c: R.medication_dose_matrix(c.encounters),
         f"WITH {_DOSES}, {_DOSE_RATE} SELECT medication, " + ", ".join(
             f"MAX(early_share) FILTER (WHERE dose_change = '{d}') AS \"{d}\""
             for d in ("Decreased", "Increased", "No Change", "Not Given"))
         + " FROM rates GROUP BY 1")
register("rate_by_discharge",
         lambda c: R.rate_by_discharge(c.encounters.join(
             c.discharge_disposition, "discharge_disposition_id", "left")), f"""
SELECT discharge_disposition_desc, {null_share('<30')} AS early_share,
  {null_share('>30')} AS late_share
FROM {{encounters}} JOIN {{discharge_disposition}} USING (discharge_disposition_id)
WHERE readmitted <> 'NO' GROUP BY 1""")
_CATS = ", ".join(f"('{n}')" for n in K.ICD9_CATEGORY_ORDER)
register("icd9_category_counts", lambda c: R.icd9_category_counts(c.encounters), f"""
WITH cats(category) AS (VALUES {_CATS}), rows AS ({union_sql(
    f"SELECT '{d}' AS diagnosis, {X.icd9(d, False)} AS category FROM {{encounters}}"
    for d in K.DIAGNOSIS_COLUMNS)})
SELECT d.diagnosis, c.category, COUNT(r.category) AS n
FROM (SELECT DISTINCT diagnosis FROM rows) d CROSS JOIN cats c
LEFT JOIN rows r ON r.diagnosis = d.diagnosis AND r.category = c.category GROUP BY 1, 2""")
register("category_modes", lambda c: R.category_modes(c.encounters), union_sql(
    f"(SELECT '{d}_category' AS \"column\", {X.icd9(d, False)} AS mode FROM {{encounters}} "
    "GROUP BY 2 ORDER BY COUNT(*) DESC, 2 LIMIT 1)" for d in K.DIAGNOSIS_COLUMNS))

# --- ordered ----------------------------------------------------------------------------------
_W = ["encounter_id", "patient_nbr", "time_in_hospital", "readmitted"]


def _coded(c):
    return c.encounters.select(*_W).withColumn(
        "readmitted_code", C.encode_target(F.col("readmitted"), "multiclass"))


_CODED = f"coded AS (SELECT {', '.join(_W)}, {X.CODE3} AS readmitted_code FROM {{encounters}})"
_BY = "PARTITION BY patient_nbr ORDER BY encounter_id"
register("encounter_index", lambda c: O.encounter_index(_coded(c)),
         f"WITH {_CODED} SELECT *, ROW_NUMBER() OVER ({_BY}) AS encounter_index FROM coded")
register("expanding_avg_stay", lambda c: O.expanding_avg_stay(_coded(c)),
         f"WITH {_CODED} SELECT *, AVG(time_in_hospital) OVER ({_BY} ROWS UNBOUNDED PRECEDING) "
         "AS rolling_avg FROM coded")
register("global_encounter_index", lambda c: O.global_encounter_index(_coded(c)),
         f"WITH {_CODED} SELECT *, ROW_NUMBER() OVER (ORDER BY encounter_id) - 1 AS global_index "
         "FROM coded")
register("rolling_readmission_rate", lambda c: O.rolling_readmission_rate(_coded(c)), f"""
WITH {_CODED} SELECT *, ROW_NUMBER() OVER (ORDER BY encounter_id) - 1 AS global_index,
  AVG(readmitted_code) OVER (ORDER BY encounter_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)
    AS rolling_rate FROM coded""")
_PREVIOUS = f"""previous AS (SELECT *, COALESCE(CAST(SUM(readmitted_code) OVER ({_BY}
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS num_previous_readmissions
  FROM coded)"""
register("previous_readmissions", lambda c: O.previous_readmissions(_coded(c)),
         f"WITH {_CODED}, {_PREVIOUS} SELECT * FROM previous")

# --- statistics -------------------------------------------------------------------------------


def _icu(c):
    return (c.encounters.join(c.admission_source, "admission_source_id", "left")
            .filter("readmitted <> 'NO'")
            .select(C.icu_flag(F.col("admission_source_desc")).alias("icu"), "readmitted",
                    C.encode_target(F.col("readmitted"), "multiclass").alias("code")))


_ICU = f"""icu AS (SELECT CASE WHEN regexp_matches(lower(admission_source_desc),
  'emergency room|transfer from critical access hospital|transfer from a hospital')
  THEN 1 ELSE 0 END AS icu, readmitted, {X.CODE3} AS code
  FROM {{encounters}} LEFT JOIN {{admission_source}} USING (admission_source_id)
  WHERE readmitted <> 'NO')"""
_CORR = [*COUNTS, "admission_type_id", "discharge_disposition_id", "admission_source_id"]
register("correlation_matrix",
         lambda c: rounded(T.correlation_matrix(c.encounters), 7),
         union_sql(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                   f"ROUND(CORR({a}, {b}), 7) AS corr FROM {{encounters}}"
                   for a in _CORR for b in _CORR))
register("pearson_icu_readmission",
         lambda c: rounded(T.pearson(_icu(c), F.col("icu"), F.col("code")), 7),
         f"WITH {_ICU} SELECT ROUND(CORR(icu, code), 7) AS pearson FROM icu")


def chi_sql(source, a, b):
    """Chi-square the long way: every cell of the grid, corrected for two by two tables."""
    return f"""
rws AS (SELECT {a} AS a, COUNT(*) AS r FROM {source} GROUP BY 1),
cls AS (SELECT {b} AS b, COUNT(*) AS c FROM {source} GROUP BY 1),
tot AS (SELECT COUNT(*) AS n FROM {source}),
dof AS (SELECT (SELECT COUNT(*) - 1 FROM rws) * (SELECT COUNT(*) - 1 FROM cls) AS dof),
grid AS (SELECT a, b, CAST(r AS DOUBLE) * c / n AS e,
  CAST((SELECT COUNT(*) FROM {source} x WHERE x.{a} = rws.a AND x.{b} = cls.b) AS DOUBLE) AS o
  FROM rws, cls, tot),
chi AS (SELECT SUM(CASE WHEN (SELECT dof FROM dof) = 1
  THEN power(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE power(o - e, 2) END / e) AS chi2 FROM grid)
SELECT (SELECT n FROM tot) AS n, (SELECT dof FROM dof) AS dof, ROUND(chi2, 7) AS chi2,
  ROUND(sqrt(chi2 / ((SELECT n FROM tot) * (least((SELECT COUNT(*) FROM rws),
    (SELECT COUNT(*) FROM cls)) - 1))), 7) AS cramers_v FROM chi"""


register("cramers_v_icu_readmission",
         lambda c: rounded(T.association(_icu(c), F.col("icu"), F.col("readmitted")), 7),
         f"WITH {_ICU}, {chi_sql('icu', 'icu', 'readmitted')}")
register("association_race_readmission",
         lambda c: rounded(T.association(c.encounters, F.col("race"), F.col("readmitted")), 7),
         f"WITH e AS (SELECT race, readmitted FROM {{encounters}}), {chi_sql('e', 'race', 'readmitted')}")
register("anova_oneway",
         lambda c: rounded(T.anova_oneway(O.previous_readmissions(_coded(c)),
                                          "num_previous_readmissions", "time_in_hospital")
                           .drop("p_value"), 7), f"""
WITH {_CODED}, {_PREVIOUS},
g AS (SELECT num_previous_readmissions AS g, COUNT(*) AS n, AVG(time_in_hospital) AS m
  FROM previous GROUP BY 1),
t AS (SELECT COUNT(*) AS n, AVG(time_in_hospital) AS m FROM previous),
w AS (SELECT SUM(power(time_in_hospital - g.m, 2)) AS ssw FROM previous p
  JOIN g ON g.g = p.num_previous_readmissions)
SELECT COUNT(*) AS groups, ANY_VALUE(t.n) AS n, COUNT(*) - 1 AS df_between,
  ANY_VALUE(t.n) - COUNT(*) AS df_within,
  ROUND((SUM(g.n * power(g.m - t.m, 2)) / (COUNT(*) - 1))
    / (ANY_VALUE(w.ssw) / (ANY_VALUE(t.n) - COUNT(*))), 7) AS f_statistic
FROM g, t, w""")
# DuckDB has no F distribution; the tests hold the p-value against known ones
register("anova_p_value", lambda c: T.anova_oneway(
    O.previous_readmissions(_coded(c)), "num_previous_readmissions", "time_in_hospital"))
