"""Readmission rates, stays and diagnosis tables.

Grouping keys that are null are left out, as an exploratory table does. A share whose count is zero
is null where the table is read class by class, and zero where it is stacked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C

CLASSES = ["<30", ">30"]


def _grouped(df: DataFrame, **keys: Column) -> DataFrame:
    out = df.withColumns(keys)
    for k in keys:
        out = out.filter(F.col(k).isNotNull())
    return out


def readmitted_only(df: DataFrame) -> DataFrame:
    """Rows whose class is not NO; an unknown class stays."""
    return df.filter(~F.col("readmitted").eqNullSafe("NO"))


def _share(cls: str, empty_is_null: bool) -> Column:
    n = F.count_if(F.col("readmitted") == cls)
    n = F.nullif(n, F.lit(0)) if empty_is_null else n
    return F.try_divide(n.cast("double") * 100.0, F.count("readmitted"))


def _age_group(df: DataFrame) -> Column:
    return F.col("age_group") if "age_group" in df.columns else C.age_group(F.col("age"))


def avg_stay_by_age(df: DataFrame) -> DataFrame:
    return (_grouped(df, age_group=_age_group(df)).groupBy("age_group")
            .agg(F.avg("time_in_hospital").alias("avg_stay")).orderBy("age_group"))


def stay_quartiles_by_age_gender(df: DataFrame, stay: str = "time_in_hospital",
                                 approx: bool = False) -> DataFrame:
    """Box-plot figures per age group and gender: quartiles, 1.5 IQR whiskers, outliers.

    Stays are first counted by value; everything after works on those counts. ``approx`` takes the
    quartiles from a sketch instead.
    """
    keys = ["age_group", "gender"]
    rows = _grouped(df, age_group=_age_group(df)).filter("gender IS NOT NULL")
    counts = (rows.filter(F.col(stay).isNotNull())
              .groupBy(*keys, F.col(stay).cast("double").alias("value")).agg(F.count("*").alias("n")))
    names = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    if approx:
        box = rows.groupBy(*keys).agg(
            *[F.percentile_approx(F.col(stay).cast("double"), p).alias(a) for p, a in names.items()])
    else:
        # a row per distinct stay of a group, days in a hospital: a few hundred whatever the input
        box = counts.groupBy(*keys).agg(
            *[F.percentile("value", F.lit(p), F.col("n")).alias(a) for p, a in names.items()])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (counts.join(box, keys).groupBy(*keys)
            .agg(F.sum("n").alias("n"), *[F.first(a).alias(a) for a in names.values()],
                 F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"))
            .orderBy(*keys))


def stacked_diagnoses(df: DataFrame, columns=tuple(K.DIAGNOSIS_COLUMNS)) -> DataFrame:
    present = [F.col(c) for c in columns if c in df.columns]
    return df.select(F.explode(F.array(*present)).alias("code")).filter("code IS NOT NULL")


def top_diagnoses(df: DataFrame, n: int = 10, normalized: bool = False) -> DataFrame:
    """Most frequent codes over the three diagnosis columns; ties by code."""
    codes = stacked_diagnoses(df)
    if normalized:
        codes = codes.select(C.normalize_icd9(F.col("code")).alias("code"))
    out = (codes.groupBy("code").agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), F.asc("code")).limit(n))
    return out.withColumn("label", C.diagnosis_label(F.col("code"))) if normalized else out


def rate_by_age_gender(df: DataFrame) -> DataFrame:
    """Share of each class among the readmitted, long: (age_group, gender, readmitted, percentage)."""
    shares = (readmitted_only(_grouped(df, age_group=_age_group(df)))
              .filter("gender IS NOT NULL AND readmitted IS NOT NULL")
              .groupBy("age_group", "gender").agg(*[_share(c, False).alias(c) for c in CLASSES]))
    return shares.unpivot(["age_group", "gender"], [C.col(c) for c in CLASSES], "readmitted",
                          "percentage")


def rate_by_age_gender_wide(df: DataFrame, genders: list[str] | None = None) -> DataFrame:
    """The same shares with one column per gender and class."""
    long = rate_by_age_gender(df)
    names = genders and [f"{g} {c}" for g in genders for c in CLASSES]
    cells = long.withColumn("cell", F.concat_ws(" ", "gender", "readmitted"))
    return (cells.groupBy("age_group").pivot("cell", names).agg(F.max("percentage"))
            .orderBy("age_group"))


def early_rate_by_age_gender(df: DataFrame) -> DataFrame:
    """Early and other share over all patients of an age group and gender."""
    early = F.count_if(F.col("readmitted").eqNullSafe("<30")).cast("double") * 100.0 / F.count("*")
    return (_grouped(df, age_group=_age_group(df)).filter("gender IS NOT NULL")
            .groupBy("age_group", "gender").agg(early.alias("early_rate"))
            .withColumn("no_early_rate", F.lit(100.0) - F.col("early_rate"))
            .orderBy("age_group", "gender"))


def early_rate_long(df: DataFrame) -> DataFrame:
    return early_rate_by_age_gender(df).unpivot(
        ["age_group", "gender"], ["early_rate", "no_early_rate"], "measure", "percentage")


def readmit_gender_matrix(df: DataFrame, genders=("Female", "Male")) -> DataFrame:
    """Share within an age group of every readmission bin and gender."""
    bins = ["Early Readmission", "No Early Readmission"]
    cell = C.readmit_bin(F.col("readmitted"))
    share = lambda b, g: F.count_if((cell == b) & (F.col("gender") == g)).cast("double") * 100.0 / F.count("*")  # noqa: E731,E501
    return (_grouped(df, age_group=_age_group(df)).groupBy("age_group")
            .agg(*[share(b, g).alias(f"{b}-{g}") for b in bins for g in genders])
            .orderBy("age_group"))


def with_dominant_disease(df: DataFrame,
                          categorize: Callable[[Column], Column] = C.categorize_disease) -> DataFrame:
    return df.withColumn("comorbidity_group",
                         C.dominant(*[categorize(F.col(d)) for d in K.DIAGNOSIS_COLUMNS]))


def rate_by_comorbidity(df: DataFrame, readmitted: bool = False,
                        categorize: Callable[[Column], Column] = C.categorize_disease) -> DataFrame:
    """Rates by the dominant disease group: over all patients, or class shares of the readmitted."""
    named = with_dominant_disease(df, categorize).filter("comorbidity_group IS NOT NULL")
    if readmitted:
        return (readmitted_only(named).filter("readmitted IS NOT NULL")
                .groupBy("comorbidity_group")
                .agg(_share("<30", True).alias("early_share"), _share(">30", True).alias("late_share"))
                .orderBy("comorbidity_group"))
    early = F.count_if(F.col("readmitted").eqNullSafe("<30")).cast("double") * 100.0 / F.count("*")
    other = F.count_if(~F.col("readmitted").eqNullSafe("<30")).cast("double") * 100.0 / F.count("*")
    return (named.groupBy("comorbidity_group")
            .agg(F.count("*").alias("patients"), early.alias("early_rate"),
                 other.alias("no_early_rate"))
            .orderBy("comorbidity_group"))


def rate_by_medication_dose(df: DataFrame, drugs=tuple(K.RATE_DRUGS)) -> DataFrame:
    """Share of early cases among the readmitted per drug and dose change; 100 percent is null."""
    present = [d for d in drugs if d in df.columns]
    cells = F.explode(F.array(*[
        F.struct(F.lit(d).alias("medication"), C.dose_change(C.col(d)).alias("dose_change"))
        for d in present]))
    return (readmitted_only(df).filter("readmitted IS NOT NULL")
            .select("readmitted", cells.alias("_c")).select("readmitted", "_c.*")
            .groupBy("medication", "dose_change")
            .agg(F.nullif(_share("<30", True), F.lit(100.0)).alias("early_share"))
            .orderBy("medication", "dose_change"))


def medication_dose_matrix(df: DataFrame, drugs=tuple(K.RATE_DRUGS)) -> DataFrame:
    doses = sorted(set(K.DOSE_TEXT.values()))
    return (rate_by_medication_dose(df, drugs).groupBy("medication")
            .pivot("dose_change", doses).agg(F.max("early_share")).orderBy("medication"))


def rate_by_discharge(df: DataFrame) -> DataFrame:
    return (readmitted_only(df)
            .filter("discharge_disposition_desc IS NOT NULL AND readmitted IS NOT NULL")
            .groupBy("discharge_disposition_desc")
            .agg(_share("<30", True).alias("early_share"), _share(">30", True).alias("late_share"))
            .orderBy("discharge_disposition_desc"))


def _long(df: DataFrame, columns: dict[str, Column], name: str, value: str) -> DataFrame:
    """(name, value) rows of some expressions; they are computed once, before the rows multiply."""
    wide = df.select(*[e.alias(n) for n, e in columns.items()])
    return wide.unpivot([], list(columns), name, value)


def _categories(diabetes_closed: bool, suffix: str = "") -> dict[str, Column]:
    return {f"{d}{suffix}": C.icd9_category(F.col(d), diabetes_closed) for d in K.DIAGNOSIS_COLUMNS}


def icd9_category_counts(df: DataFrame, diabetes_closed: bool = False) -> DataFrame:
    """Counts of the nine groups in each diagnosis column, zeros included."""
    per_column = (_long(df, _categories(diabetes_closed), "diagnosis", "category")
                  .groupBy("diagnosis")
                  .agg(*[F.count_if(F.col("category") == name).alias(name)
                         for name in K.ICD9_CATEGORY_ORDER]))
    return per_column.unpivot(["diagnosis"], K.ICD9_CATEGORY_ORDER, "category", "n")


def column_modes(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Most frequent value of each expression, ties to the smallest."""
    return (_long(df, columns, "column", "value").filter("value IS NOT NULL")
            .groupBy("column", "value").agg(F.count("*").alias("n"))
            .groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("_top"))
            .select("column", F.col("_top.value").alias("mode")))


def category_modes(df: DataFrame, diabetes_closed: bool = False) -> DataFrame:
    return column_modes(df, _categories(diabetes_closed, "_category"))
