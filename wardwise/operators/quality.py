"""Validation of the stored tables, key checks and the long medication form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C


def _null_counts(df: DataFrame) -> list:
    return [F.count_if(C.col(n).isNull()).alias(f"null_{n}") for n in df.columns]


def _invalid() -> Column:
    """The ``readmitted`` value if it is none of the known ones."""
    bad = ~F.coalesce(F.col("readmitted").isin(*K.READMITTED_VALUES), F.lit(False))
    return F.when(bad, F.coalesce(F.col("readmitted"), F.lit("(null)")))


def invalid_readmitted(df: DataFrame) -> DataFrame:
    """Every invalid ``readmitted`` value with its number of rows."""
    return (df.groupBy(_invalid().alias("value")).agg(F.count("*").alias("n"))
            .filter("value IS NOT NULL"))


def validate_patients(df: DataFrame) -> DataFrame:
    """One row: rows, nulls per column, ranges with their limits, number of invalid values, verdict.

    Ranges are reported only; a missing patient id or an unknown ``readmitted`` value fails. The
    values themselves are the rows of ``invalid_readmitted``.
    """
    per_value = (df.groupBy(_invalid().alias("_bad")).agg(
        F.count("*").alias("_n"), *_null_counts(df),
        *[agg(c).alias(f"{word}_{c}") for c in ("age", "time_in_hospital")
          for word, agg in (("min", F.min), ("max", F.max))]))
    # per_value has one row for every valid row together and one per invalid value
    out = per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        *[F.coalesce(F.sum(f"null_{n}"), F.lit(0)).alias(f"null_{n}") for n in df.columns],
        *[agg(f"{word}_{c}").alias(f"{word}_{c}") for c in ("age", "time_in_hospital")
          for word, agg in (("min", F.min), ("max", F.max))],
        F.count("_bad").alias("invalid_readmitted"),
    )
    inside = lambda c, lim: (F.col(f"min_{c}") >= lim[0]) & (F.col(f"max_{c}") <= lim[1])
    return out.withColumns({
        "age_in_range": inside("age", K.VALID_AGE),
        "stay_in_range": inside("time_in_hospital", K.VALID_STAY),
        "is_valid": (F.col("null_patient_id") == 0) & (F.col("invalid_readmitted") == 0),
    })


def validate_medications(df: DataFrame) -> DataFrame:
    """One row: rows, nulls per column, number of distinct names, verdict."""
    per_name = df.groupBy(F.col("medication_name").alias("_name")).agg(
        F.count("*").alias("_n"), *_null_counts(df))
    return per_name.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        *[F.coalesce(F.sum(f"null_{n}"), F.lit(0)).alias(f"null_{n}") for n in df.columns],
        F.count("_name").alias("distinct_medications"),
    ).withColumns({
        "names_consistent": F.col("distinct_medications") > 0,
        "is_valid": F.col("null_patient_id") == 0,
    })


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, or are null, with their count."""
    return (df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
            .filter((F.col("n") > 1) | F.col("key").isNull()))


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys that no parent row has; a null reference is allowed."""
    refs = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return refs.join(parent.select(key), key, "left_anti")


def key_checks(tables: dict[str, DataFrame], primary: dict[str, str],
               foreign: list[tuple[str, str, str]]) -> DataFrame:
    """One row per check with the number of offending keys."""
    rows = [duplicate_keys(tables[t], k).agg(F.count("*").alias("violations"))
            .select(F.lit(f"primary:{t}.{k}").alias("check"), "violations")
            for t, k in primary.items()]
    rows += [orphan_keys(tables[c], tables[p], k).agg(F.count("*").alias("violations"))
             .select(F.lit(f"foreign:{c}.{k}->{p}").alias("check"), "violations")
             for c, p, k in foreign]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def medications_long(encounters: DataFrame, patient_id: str = "encounter_id",
                     drugs: list[str] | None = None) -> DataFrame:
    """One row per encounter and given drug from the wide drug columns."""
    wanted = K.DRUG_COLUMNS if drugs is None else drugs
    present = [d for d in wanted if d in encounters.columns]
    wide = encounters.select(C.col(patient_id).cast("string").alias("patient_id"),
                             *[C.col(d) for d in present])
    long = wide.unpivot(["patient_id"], [C.col(d) for d in present], "medication_name",
                        "dosage_change")
    return long.filter(F.col("dosage_change") != "No")
