"""The SQL analytics suite over patients, medications and model results.

PostgreSQL sorts nulls last ascending and first descending; every sort says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.functions import clinical as C
from wardwise.session import materialize


def up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _is(*values: str) -> Column:
    return F.count_if(F.col("readmitted").isin(*values))


def _rate(*values: str, over: Column | None = None) -> Column:
    rows = F.count("*") if over is None else over
    return F.round(_is(*values).cast("double") * 100.0 / rows, 2)


def _early() -> Column:
    return _is("<30").alias("early_readmissions")


def _late() -> Column:
    return _is(">30").alias("late_readmissions")


def _never() -> Column:
    return _is("NO").alias("no_readmissions")


def _early_rate() -> Column:
    return _rate("<30").alias("early_readmission_rate")


def _avg_stay() -> Column:
    return F.avg("time_in_hospital").alias("avg_length_of_stay")


def demographics(patients: DataFrame) -> DataFrame:
    return (patients.groupBy("age", "gender", "race")
            .agg(F.count("*").alias("patient_count"), _avg_stay(), _early(), _late(), _never(),
                 _rate("<30", ">30").alias("overall_readmission_rate"))
            .orderBy(up("age"), up("gender"), up("race")))


def readmission_stats(patients: DataFrame) -> DataFrame:
    return (patients.groupBy("age", "gender")
            .agg(F.count("*").alias("total_patients"), _early(), _late(), _never(), _early_rate())
            .orderBy(up("age"), up("gender")))


def risk_factors(patients: DataFrame) -> DataFrame:
    return (patients
            .groupBy("admission_type_id", "discharge_disposition_id", "admission_source_id")
            .agg(F.count("*").alias("total_cases"), _early(), _early_rate(), _avg_stay(),
                 F.avg("num_medications").alias("avg_medications"),
                 F.avg("num_lab_procedures").alias("avg_lab_procedures"))
            .orderBy(down("early_readmission_rate")))


def diagnosis_analysis(patients: DataFrame, min_count: int = 10, top: int = 20) -> DataFrame:
    return (patients.filter(~C.is_missing(F.col("diag_1")))
            .groupBy("diag_1")
            .agg(F.count("*").alias("diagnosis_count"), _early(), _late(), _never(), _early_rate(), _avg_stay())
            .filter(F.col("diagnosis_count") >= min_count)
            .orderBy(down("early_readmission_rate"), up("diag_1")).limit(top))


def medication_impact(medications: DataFrame, patients: DataFrame, min_patients: int = 5,
                      against_all: bool = False) -> DataFrame:
    """Use and readmission by medication. ``against_all`` relates use to every patient.

    Medications are first reduced to one row per patient and drug, so a patient with very many
    medication rows joins as a few rows, and patients are counted without a second distinct pass.
    """
    per_patient = (medications.groupBy("patient_id", "medication_name")
                   .agg(F.count("*").alias("rows")))
    out = (per_patient.join(patients.select("patient_id", "readmitted"), "patient_id")
           .groupBy("medication_name", "patient_id")
           .agg(F.sum(F.when(F.col("readmitted") == "<30", F.col("rows")).otherwise(0))
                .alias("early"))
           .groupBy("medication_name")
           .agg(F.count("*").alias("patients_on_medication"),
                F.sum("early").alias("early_readmissions"))
           .filter(F.col("patients_on_medication") >= min_patients))
    everyone = F.col("patients_on_medication")
    if against_all:
        everyone = patients.agg(F.count_distinct("patient_id")).scalar()
    rounded = lambda part, whole: F.round(part.cast("double") * 100.0 / whole, 2)
    return (out.withColumn("total_patients", everyone)
            .withColumn("medication_usage_rate",
                        rounded(F.col("patients_on_medication"), F.col("total_patients")))
            .withColumn("readmission_rate_with_medication",
                        rounded(F.col("early_readmissions"), F.col("patients_on_medication")))
            .orderBy(down("readmission_rate_with_medication")))


def length_of_stay(patients: DataFrame) -> DataFrame:
    return (patients
            .groupBy(C.stay_category(F.col("time_in_hospital")).alias("stay_category"))
            .agg(F.count("*").alias("patient_count"), _early(), _late(), _never(), _early_rate(), _avg_stay())
            .orderBy(up("avg_length_of_stay")))


def comorbidity_analysis(patients: DataFrame) -> DataFrame:
    """Results by number of recorded diagnoses of a patient.

    A patient with several rows is counted with the total over its rows, and each of its rows is
    a case. Rows are pre-aggregated per patient, so nothing is joined back.
    """
    diagnoses = C.comorbidity_count(F.col("diag_1"), F.col("diag_2"), F.col("diag_3"))
    per_patient = patients.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.sum(diagnoses).alias("n"), F.count("*").alias("rows"), _is("<30").alias("early"),
        F.sum("time_in_hospital").alias("days"), F.count("time_in_hospital").alias("stays"),
        F.sum("num_medications").alias("drugs"), F.count("num_medications").alias("counted"))
    mean = lambda total, rows: F.try_divide(F.sum(total).cast("double"), F.sum(rows))
    return (per_patient.groupBy(C.comorbidity_name(F.col("n")).alias("comorbidity_category"))
            .agg(F.sum("rows").alias("patient_count"), F.sum("early").alias("early_readmissions"),
                 F.round(F.sum("early").cast("double") * 100.0 / F.sum("rows"), 2)
                 .alias("early_readmission_rate"),
                 mean("days", "stays").alias("avg_length_of_stay"),
                 mean("drugs", "counted").alias("avg_medications"),
                 F.min("n").alias("order_key"))
            .orderBy("order_key").drop("order_key"))


def operational_metrics(patients: DataFrame) -> DataFrame:
    return patients.agg(
        F.count("*").alias("total_patients"), _avg_stay(), _early(), _late(),
        _rate("<30", ">30").alias("overall_readmission_rate"), _early_rate(),
        F.avg("num_medications").alias("avg_medications_per_patient"),
        F.avg("num_lab_procedures").alias("avg_lab_procedures_per_patient"),
        F.count_distinct("diag_1").alias("unique_primary_diagnoses"))


_METRICS = ["accuracy", "precision", "recall", "f1_score", "auc_score"]
_SETTING = ["model_name", "feature_selection_method", "top_n_features"]


def _averages(metrics=_METRICS) -> list[Column]:
    return [F.avg(m).alias(f"avg_{m}") for m in metrics]


def model_trends(results: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Daily averages of the last days; ``as_of`` is today unless given."""
    today = F.current_date() if as_of is None else as_of
    return (results.filter(F.col("created_at") >= F.date_sub(today, days))
            .groupBy(F.to_date("created_at").alias("run_date"), *_SETTING)
            .agg(*_averages(), F.count("*").alias("runs_count"))
            .orderBy(down("run_date"), down("avg_auc_score")))


def best_models(results: DataFrame) -> DataFrame:
    """Rows that lead their model by AUC or by F1; the smaller id wins a tie.

    Each lead is a top-one rank, which Spark cuts per map task before the shuffle, so a model with
    very many runs never fills one task.
    """
    def lead(metric: str) -> DataFrame:
        w = Window.partitionBy("model_name").orderBy(down(metric), up("id"))
        return results.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")

    return (lead("auc_score").unionByName(lead("f1_score")).distinct()
            .select(*_SETTING, *_METRICS, "created_at")
            .orderBy(down("auc_score"), down("f1_score")))


def feature_selection_analysis(results: DataFrame) -> DataFrame:
    return (results.groupBy("feature_selection_method", "top_n_features")
            .agg(F.count("*").alias("model_runs"),
                 F.avg("auc_score").alias("avg_auc_score"),
                 F.stddev_samp("auc_score").alias("auc_std_dev"),
                 F.avg("f1_score").alias("avg_f1_score"),
                 F.stddev_samp("f1_score").alias("f1_std_dev"),
                 F.min("auc_score").alias("min_auc_score"),
                 F.max("auc_score").alias("max_auc_score"))
            .orderBy(down("avg_auc_score"), down("avg_f1_score")))


def model_performance_summary(results: DataFrame) -> DataFrame:
    return (results.groupBy(*_SETTING)
            .agg(*_averages(), F.count("*").alias("num_runs"))
            .orderBy(down("avg_auc_score")))


def data_summary(patients: DataFrame) -> DataFrame:
    """Counts, distributions and age statistics as one long table (section, item, value).

    One pass groups by the two small categories; all sections follow from its written result.
    """
    cells = materialize(patients.groupBy("readmitted", "gender").agg(
        F.count("*").alias("n"), F.min("age").alias("low"), F.max("age").alias("high"),
        F.count("age").alias("known"), F.sum("age").cast("double").alias("s1"),
        F.sum(F.col("age").cast("double") * F.col("age")).alias("s2")), "summary")
    text = lambda name: F.coalesce(F.col(name), F.lit("(null)"))

    def section(name: str, key: Column) -> DataFrame:
        return cells.groupBy(key.alias("item")).agg(F.sum("n").cast("double").alias("value")).select(
            F.lit(name).alias("section"), "item", "value")

    known, s1, s2 = F.sum("known"), F.sum("s1"), F.sum("s2")
    variance = F.try_divide(s2 - s1 * s1 / F.nullif(known, F.lit(0)), F.nullif(known - 1, F.lit(0)))
    stats = cells.agg(F.min("low").cast("double").alias("min_age"),
                      F.max("high").cast("double").alias("max_age"),
                      F.try_divide(s1, known).alias("avg_age"),
                      F.sqrt(variance).alias("std_age"))
    ages = stats.unpivot([], stats.columns, "item", "value").select(
        F.lit("age_statistics").alias("section"), "item", "value")
    return (section("total", F.lit("patients"))
            .unionByName(section("readmission_distribution", text("readmitted")))
            .unionByName(section("gender_distribution", text("gender")))
            .unionByName(ages))


def patient_history(patients: DataFrame, patient_id: str) -> DataFrame:
    return (patients.filter(F.col("patient_id") == patient_id)
            .select("patient_id", "age", "gender", "race", "admission_type_id",
                    "discharge_disposition_id", "time_in_hospital", "num_medications",
                    "num_lab_procedures", "diag_1", "diag_2", "diag_3", "readmitted",
                    F.col("created_at").alias("encounter_date"))
            .orderBy(down("encounter_date")))


def high_risk_patients(patients: DataFrame, threshold: float = 0.3) -> DataFrame:
    score = C.risk_score(F.col("num_medications"), F.col("time_in_hospital"),
                         F.col("num_lab_procedures"))
    return (patients.select("patient_id", "age", "gender", "time_in_hospital", "num_medications",
                            "num_lab_procedures", "diag_1", "diag_2", "diag_3", "readmitted",
                            score.alias("risk_score"))
            .filter(F.col("risk_score") >= threshold)
            .orderBy(down("risk_score"), down("num_medications")))


def analytics_bundle(patients: DataFrame, medications: DataFrame, results: DataFrame,
                     as_of: Column | None = None) -> dict[str, DataFrame]:
    """The ten named result sets, lazily."""
    return {
        "demographics": demographics(patients),
        "risk_factors": risk_factors(patients),
        "diagnosis": diagnosis_analysis(patients),
        "medication_impact": medication_impact(medications, patients),
        "length_of_stay": length_of_stay(patients),
        "comorbidity": comorbidity_analysis(patients),
        "model_trends": model_trends(results, as_of),
        "best_models": best_models(results),
        "operational_metrics": operational_metrics(patients),
        "feature_importance": feature_selection_analysis(results),
    }


def summary_bundle(patients: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    """The three overview result sets, lazily."""
    return {
        "patient_stats": readmission_stats(patients),
        "model_performance": model_performance_summary(results),
        "data_summary": data_summary(patients),
    }
