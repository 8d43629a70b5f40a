"""Lookup joins and cohort filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise import constants as K
from wardwise.functions import clinical as C


def merge_codes(encounters: DataFrame, admission_type: DataFrame,
                discharge_disposition: DataFrame, admission_source: DataFrame,
                drop=("admission_type_id", "admission_source_id")) -> DataFrame:
    """Left join the three lookups and drop the ids that are no longer needed.

    The lookups stay without a hint: Spark broadcasts them while they are below its size
    threshold, and adaptive execution splits a skewed id if one ever grows beyond it.
    """
    return (encounters
            .join(admission_type, "admission_type_id", "left")
            .join(discharge_disposition, "discharge_disposition_id", "left")
            .join(admission_source, "admission_source_id", "left")
            .drop(*drop))


def index_admissions(df: DataFrame, patient: str = "patient_nbr",
                     order: str = "encounter_id") -> DataFrame:
    """First encounter of every patient.

    The rank filter becomes a window group limit: each map task keeps one row per patient before
    the shuffle, so a patient with very many encounters does not reach one task whole.
    """
    w = Window.partitionBy(patient).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def exclude_dispositions(df: DataFrame, ids=tuple(K.DEATH_OR_HOSPICE_IDS)) -> DataFrame:
    """Drop deaths and hospice discharges; an unknown disposition stays."""
    listed = F.col("discharge_disposition_id").isin(*ids)
    return df.filter(~F.coalesce(listed, F.lit(False)))


def index_cohort(clinic) -> DataFrame:
    """Index admissions without deaths, with the lookups merged.

    The order of the two filters matters. The lookups join one row each, so they are merged after
    the filters: fewer rows, and narrower ones in the shuffle.
    """
    return merged_cohort(clinic, clinic.encounters)


def merged_cohort(clinic, encounters: DataFrame) -> DataFrame:
    first = exclude_dispositions(index_admissions(encounters))
    return merge_codes(first, clinic.admission_type, clinic.discharge_disposition,
                       clinic.admission_source)


def diabetes_any(df: DataFrame) -> DataFrame:
    return df.filter(C.any_diabetes(*[F.col(c) for c in K.DIAGNOSIS_COLUMNS]))


def diabetes_primary(df: DataFrame) -> DataFrame:
    return df.filter(C.is_diabetes(F.col("diag_1")))


def diabetes_share(df: DataFrame) -> DataFrame:
    """Count and share of encounters with any, and with a primary, diabetes diagnosis."""
    flags = {"any": C.any_diabetes(*[F.col(c) for c in K.DIAGNOSIS_COLUMNS]),
             "primary": C.is_diabetes(F.col("diag_1"))}
    row = df.agg(F.count("*").alias("total"),
                 *[F.count_if(flag).alias(name) for name, flag in flags.items()])
    return row.unpivot(["total"], list(flags), "cohort", "encounters").select(
        "cohort", "encounters", "total",
        F.try_divide(F.col("encounters").cast("double"), F.col("total")).alias("share"))


def comorbidity_cohort(df: DataFrame, level: int) -> DataFrame:
    return df.filter(F.col("comorbidity") == level)


def mask_diabetes_diagnoses(df: DataFrame) -> DataFrame:
    """Null every 250.x diagnosis and, where present, its category."""
    masked = {}
    for name in K.DIAGNOSIS_COLUMNS:
        for target in (name, f"{name}_category"):
            if target in df.columns:
                masked[target] = F.when(~C.is_diabetes(F.col(name)), F.col(target))
    return df.withColumns(masked)


def with_comorbidity_counts(df: DataFrame, patient: str = "patient_id",
                            codes=tuple(K.DIAGNOSIS_COLUMNS)) -> DataFrame:
    """Every row with n, the number of diagnoses given in all rows of its patient."""
    counts = df.groupBy(patient).agg(
        F.sum(C.comorbidity_count(*[F.col(c) for c in codes])).cast("bigint").alias("n"))
    return df.join(counts.withColumnRenamed(patient, "_patient"),
                   F.col(patient).eqNullSafe(F.col("_patient")), "left").drop("_patient")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop what is present of the given columns."""
    return df.drop(*[n for n in names if n in df.columns])
