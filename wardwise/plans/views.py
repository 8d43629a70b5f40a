"""Clinical views over the base tables, as SQL that Spark and DuckDB read alike.

A view names what it reads in braces. Spark binds the braces to DataFrames; for the oracle they
become the names of common table expressions or base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {}

VIEWS["encounters"] = """
SELECT
  o.o_orderkey AS encounter_id,
  o.o_custkey AS patient_nbr,
  CASE o.o_custkey % 6 WHEN 0 THEN 'Caucasian' WHEN 1 THEN 'AfricanAmerican' WHEN 2 THEN 'Asian'
       WHEN 3 THEN 'Hispanic' WHEN 4 THEN 'Other' ELSE '?' END AS race,
  CASE WHEN o.o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  '[' || CAST(10 * (o.o_custkey % 10) AS VARCHAR(4)) || '-'
      || CAST(10 * (o.o_custkey % 10) + 10 AS VARCHAR(4)) || ')' AS age,
  CASE WHEN o.o_orderkey % 40 = 0 THEN '[75-100)' ELSE '?' END AS weight,
  CAST(1 + o.o_orderkey % 8 AS INT) AS admission_type_id,
  CAST(1 + (o.o_orderkey * 7) % 30 AS INT) AS discharge_disposition_id,
  CAST(1 + (o.o_orderkey * 11) % 26 AS INT) AS admission_source_id,
  CAST(1 + (o.o_orderkey * 5) % 16 AS INT) AS time_in_hospital,
  CASE WHEN o.o_orderkey % 5 < 2 THEN '?' ELSE 'MC' END AS payer_code,
  CASE WHEN o.o_orderkey % 7 = 0 THEN '?' ELSE 'Cardiology' END AS medical_specialty,
  CAST(1 + (o.o_orderkey * 13) % 100 AS INT) AS num_lab_procedures,
  CAST(o.o_orderkey % 7 AS INT) AS num_procedures,
  CAST(l.n_lines * 3 AS INT) AS num_medications,
  CAST((o.o_orderkey * 3) % 5 AS INT) AS number_outpatient,
  CAST((o.o_orderkey * 3) % 4 AS INT) AS number_emergency,
  CAST((o.o_orderkey * 3) % 11 AS INT) AS number_inpatient,
  CASE WHEN o.o_orderkey % 17 = 0 THEN '?' WHEN o.o_orderkey % 13 = 0 THEN 'V57'
       WHEN o.o_orderkey % 9 = 1 THEN '250.83'
       ELSE CAST(140 + (o.o_orderkey * 37) % 860 AS VARCHAR(10)) END AS diag_1,
  CASE WHEN o.o_orderkey % 19 = 0 THEN '?' WHEN o.o_orderkey % 8 = 1 THEN '250.01'
       ELSE CAST(140 + (o.o_orderkey * 41) % 860 AS VARCHAR(10)) END AS diag_2,
  CASE WHEN o.o_orderkey % 23 = 0 THEN '?' WHEN o.o_orderkey % 14 = 1 THEN 'E888'
       ELSE CAST(140 + (o.o_orderkey * 43) % 860 AS VARCHAR(10)) END AS diag_3,
  CAST(1 + o.o_orderkey % 9 AS INT) AS number_diagnoses,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Up'
       ELSE 'Down' END AS metformin,
  CASE (o.o_orderkey + o.o_custkey) % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Up'
       ELSE 'Down' END AS insulin,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'Ch' ELSE 'No' END AS change,
  CASE WHEN (o.o_orderkey * 31 + o.o_custkey) % 9 = 0 THEN '<30'
       WHEN (o.o_orderkey * 31 + o.o_custkey) % 3 = 0 THEN '>30' ELSE 'NO' END AS readmitted,
  o.o_orderdate AS created_at
FROM {orders} o
JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM {lineitem} GROUP BY l_orderkey) l
  ON l.l_orderkey = o.o_orderkey
"""

VIEWS["patients"] = """
SELECT CAST(encounter_id AS VARCHAR(50)) AS patient_id,
  CAST(10 * (patient_nbr % 10) + 5 AS INT) AS age, gender, race,
  admission_type_id, discharge_disposition_id, admission_source_id, time_in_hospital,
  num_lab_procedures, num_procedures, num_medications, number_outpatient, number_emergency,
  number_inpatient, diag_1, diag_2, diag_3, readmitted, created_at
FROM {encounters}
"""

VIEWS["medications"] = """
SELECT CAST(encounter_id AS VARCHAR(50)) AS patient_id, 'metformin' AS medication_name,
  metformin AS dosage_change FROM {encounters} WHERE metformin <> 'No'
UNION ALL
SELECT CAST(encounter_id AS VARCHAR(50)), 'insulin', insulin FROM {encounters}
WHERE insulin <> 'No'
"""

VIEWS["model_results"] = """
SELECT event_id AS id,
  CASE event_id % 3 WHEN 0 THEN 'LogisticRegression' WHEN 1 THEN 'RandomForest'
       ELSE 'GradientBoosting' END AS model_name,
  CASE (event_id * 5) % 7 WHEN 0 THEN 'L1' WHEN 1 THEN 'L1' WHEN 2 THEN 'MutualInfo'
       WHEN 3 THEN 'MutualInfo' ELSE 'TreeImportance' END AS feature_selection_method,
  CAST(5 * (1 + (event_id * 11) % 3) AS INT) AS top_n_features,
  CAST((event_id * 13) % 10000 AS DOUBLE) / 10000 AS accuracy,
  CAST((event_id * 17) % 10000 AS DOUBLE) / 10000 AS precision,
  CAST((event_id * 19) % 10000 AS DOUBLE) / 10000 AS recall,
  CAST((event_id * 23) % 10000 AS DOUBLE) / 10000 AS f1_score,
  CAST((event_id * 29) % 10000 AS DOUBLE) / 10000 AS auc_score,
  ts AS created_at
FROM {events}
"""

VIEWS["scored"] = """
SELECT encounter_id, CASE WHEN encounter_id % 25 < 16 THEN 'train'
    WHEN encounter_id % 25 < 20 THEN 'val' ELSE 'test' END AS split,
  CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label,
  CAST((encounter_id * 7919) % 1000 AS DOUBLE) / 1000 AS probability,
  CASE WHEN (encounter_id * 7919) % 1000 >= 500 THEN 1 ELSE 0 END AS prediction
FROM {encounters}
"""

VIEWS["admission_type"] = """
SELECT * FROM (VALUES (1,'Emergency'),(2,'Urgent'),(3,'Elective'),(4,'Newborn'),
  (5,'Not Available'),(6,CAST(NULL AS VARCHAR(20))),(7,'Trauma Center'),(8,'Not Mapped'))
  t(admission_type_id, admission_type_desc)
"""

VIEWS["discharge_disposition"] = """
SELECT CAST(n_nationkey + 1 AS INT) AS discharge_disposition_id,
  n_name AS discharge_disposition_desc FROM {nation}
"""

VIEWS["admission_source"] = """
SELECT CAST(n_nationkey + 1 AS INT) AS admission_source_id,
  CASE WHEN n_nationkey % 5 = 0 THEN ' Emergency Room'
       WHEN n_nationkey % 5 = 1 THEN 'Transfer from a hospital'
       ELSE n_name END AS admission_source_desc
FROM {nation}
"""

_BRACES = re.compile(r"\{(\w+)\}")


def reads(sql: str) -> list[str]:
    return list(dict.fromkeys(_BRACES.findall(sql)))


class Clinic:
    """The clinical views of one data folder as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frames = self._frames
        if name not in frames:
            if name in VIEWS:
                text = VIEWS[name]
                frames[name] = self.spark.sql(text, **{r: getattr(self, r) for r in reads(text)})
            else:
                frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return frames[name]


def oracle(body: str) -> str:
    """DuckDB statement for a body that names views in braces; views become leading CTEs.

    A body may open with ``WITH``; its own expressions then follow the views.
    """
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in reads(sql):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                ordered.append(name)

    need(body)
    body = body.strip()
    ctes = [f"{name} AS ({VIEWS[name]})" for name in ordered]
    if body.upper().startswith("WITH "):
        ctes.append(body[5:])
        text = "WITH " + ",\n".join(ctes)
    else:
        text = (f"WITH {', '.join(ctes)}\n" if ctes else "") + body
    return _BRACES.sub(r"\1", text)
