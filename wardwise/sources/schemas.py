"""Explicit schemas of the inputs and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from wardwise import constants as K


def _fields(kind: T.DataType, names) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def encounters_schema(drugs=tuple(K.DRUG_COLUMNS)) -> T.StructType:
    """Raw encounter file; pass the drug columns that the file has."""
    text, whole = T.StringType(), T.IntegerType()
    return T.StructType([
        *_fields(T.LongType(), ["encounter_id", "patient_nbr"]),
        *_fields(text, ["race", "gender", "age", "weight"]),
        *_fields(whole, ["admission_type_id", "discharge_disposition_id", "admission_source_id",
                         "time_in_hospital"]),
        *_fields(text, ["payer_code", "medical_specialty"]),
        *_fields(whole, ["num_lab_procedures", "num_procedures", "num_medications",
                         "number_outpatient", "number_emergency", "number_inpatient"]),
        *_fields(text, K.DIAGNOSIS_COLUMNS),
        *_fields(whole, ["number_diagnoses"]),
        *_fields(text, ["max_glu_serum", "A1Cresult"]),
        *_fields(text, drugs),
        *_fields(text, ["change", "diabetesMed", "readmitted"]),
    ])


_COUNTS = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
           "number_outpatient", "number_emergency", "number_inpatient"]

PATIENTS = T.StructType([
    T.StructField("patient_id", T.StringType(), False),
    T.StructField("age", T.IntegerType()),
    *_fields(T.StringType(), ["gender", "race"]),
    *_fields(T.IntegerType(), ["admission_type_id", "discharge_disposition_id",
                               "admission_source_id", *_COUNTS]),
    *_fields(T.StringType(), [*K.DIAGNOSIS_COLUMNS, "readmitted"]),
    T.StructField("created_at", T.TimestampType()),
])
ENCOUNTERS = T.StructType([
    T.StructField("encounter_id", T.StringType(), False),
    T.StructField("patient_id", T.StringType()),
    T.StructField("encounter_date", T.DateType()),
    T.StructField("encounter_type", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
MEDICATIONS = T.StructType([
    T.StructField("id", T.LongType(), False),
    *_fields(T.StringType(), ["patient_id", "medication_name", "dosage_change"]),
    T.StructField("created_at", T.TimestampType()),
])
MODEL_RESULTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    *_fields(T.StringType(), ["model_name", "feature_selection_method"]),
    T.StructField("top_n_features", T.IntegerType()),
    *_fields(T.DecimalType(5, 4), ["accuracy", "precision", "recall", "f1_score", "auc_score"]),
    T.StructField("created_at", T.TimestampType()),
])
TABLES = {"patients": PATIENTS, "encounters": ENCOUNTERS, "medications": MEDICATIONS,
          "model_results": MODEL_RESULTS}

CCS_COLUMNS = ["ICD9_Code", "CCS_Category", "CCS_Desc", "ICD9_Desc"]
CCS = T.StructType(_fields(T.StringType(), CCS_COLUMNS))
