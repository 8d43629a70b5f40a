"""Cleaning steps: sentinels, sparse columns, fills, type coercion and the table transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators.quantiles import exact_quantiles


def string_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string" or t.startswith(("varchar", "char"))]


def numeric_columns(df: DataFrame) -> list[str]:
    simple = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [n for n, t in df.dtypes if t in simple or t.startswith("decimal")]


def replace_sentinel(df: DataFrame, sentinel: str = K.SENTINEL) -> DataFrame:
    """Null instead of the sentinel in every string column."""
    return df.withColumns({n: F.nullif(C.col(n), F.lit(sentinel)) for n in string_columns(df)})


def sparse_columns(df: DataFrame, threshold: float = 50.0) -> list[str]:
    """Columns whose share of nulls is above ``threshold`` percent: one pass, one row back."""
    row = df.agg(F.count("*").alias("_rows"),
                 *[F.count_if(C.col(n).isNull()).alias(n) for n in df.columns]).first()
    return [n for n in df.columns if row["_rows"] and row[n] * 100.0 / row["_rows"] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def fill_unknown(df: DataFrame, columns=tuple(K.FILL_UNKNOWN_COLUMNS)) -> DataFrame:
    return df.fillna("Unknown", subset=[c for c in columns if c in df.columns])


def handle_missing(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Sentinel to null, drop sparse columns, fill the listed columns."""
    return fill_unknown(drop_sparse_columns(replace_sentinel(df), threshold))


def fit_medians(df: DataFrame, columns=tuple(K.MEDIAN_COLUMNS)) -> dict[str, float]:
    """Exact medians of the numeric columns among ``columns``."""
    present = [c for c in columns if c in numeric_columns(df)]
    if not present:
        return {}
    rows = exact_quantiles(df, present, [0.5]).collect()  # one row per column
    return {r["column"]: r["value"] for r in rows if r["value"] is not None}


def median_impute(df: DataFrame, columns=tuple(K.MEDIAN_COLUMNS),
                  medians: dict[str, float] | None = None) -> DataFrame:
    """Fill nulls of numeric columns with their exact median; the column becomes double."""
    medians = fit_medians(df, columns) if medians is None else medians
    return df.withColumns({c: F.coalesce(C.col(c).cast("double"), F.lit(float(m)))
                           for c, m in medians.items()})


def coerce_types(df: DataFrame, columns=tuple(K.INTEGER_COLUMNS)) -> DataFrame:
    """Whole numbers where the text is one, else null."""
    return df.withColumns({c: C.plain_number(C.col(c).cast("string")).try_cast("int")
                           for c in columns if c in df.columns})


def trim_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({n: F.trim(C.col(n)) for n in names})


def stamp_created_at(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def transform_patients(df: DataFrame, stamp: bool = True) -> DataFrame:
    out = trim_strings(coerce_types(median_impute(replace_sentinel(df))))
    return stamp_created_at(out) if stamp else out


def transform_medications(df: DataFrame, stamp: bool = True) -> DataFrame:
    out = trim_strings(median_impute(replace_sentinel(df)), ["medication_name"])
    return stamp_created_at(out) if stamp else out


def reorder_columns(df: DataFrame) -> DataFrame:
    """Raw diagnosis columns after the others, their categories last."""
    diag = [c for c in df.columns if c.startswith("diag_") and not c.endswith("_category")]
    category = [c for c in df.columns if c.endswith("_category")]
    rest = [c for c in df.columns if c not in diag and c not in category]
    return df.select(*[C.col(c) for c in [*rest, *diag, *category]])


def derive_features(df: DataFrame, compat: bool = False, diabetes_closed: bool = True) -> DataFrame:
    """Age, diagnosis group and comorbidity level columns."""
    age = F.col("age")
    return df.withColumns({
        "age_midpoint": C.age_midpoint(age, compat),
        "age_group": C.age_group(age),
        **{f"{d}_category": C.icd9_category(F.col(d), diabetes_closed)
           for d in K.DIAGNOSIS_COLUMNS},
        "comorbidity": C.comorbidity_level(F.col("number_diagnoses")),
    })
