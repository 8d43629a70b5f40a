"""Validate, transform and load files into stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwise.operators import cleaning, quality
from wardwise.sources import readers, writers

VALIDATORS = {"patients": quality.validate_patients, "medications": quality.validate_medications}
TRANSFORMS = {"patients": cleaning.transform_patients,
              "medications": cleaning.transform_medications}


def migrate_table(spark: SparkSession, csv_path: str, name: str, schema: T.StructType,
                  target: str | None = None, location: str | None = None,
                  validate_only: bool = False) -> DataFrame:
    """One row: table, rows read, rows loaded, whether it is valid, whether it succeeded."""
    source = readers.read_encounters(spark, csv_path, schema)
    validate = VALIDATORS.get(name)
    report = (validate(source).select("total_rows", "is_valid") if validate else
              source.agg(F.count("*").alias("total_rows"), F.lit(True).alias("is_valid"))).first()
    done = bool(report["is_valid"])
    loaded = 0
    if done and not validate_only:
        out = TRANSFORMS.get(name, lambda d: d)(source)
        writers.save_dataframe(out, target or name, "replace", location)
        loaded = spark.table(target or name).count()
    return spark.range(1).select(
        F.lit(name).alias("table_name"), F.lit(report["total_rows"]).cast("bigint").alias("rows_read"),
        F.lit(loaded).cast("bigint").alias("rows_loaded"), F.lit(bool(report["is_valid"])).alias("is_valid"),
        F.lit(done).alias("success"))


def migrate_all(spark: SparkSession, files: dict[str, tuple[str, T.StructType]],
                prefix: str = "", location: str | None = None,
                validate_only: bool = False) -> DataFrame:
    """One row per file; a file that fails validation does not stop the others."""
    out = None
    for name, (path, schema) in files.items():
        target = f"{prefix}{name}"
        row = migrate_table(spark, path, name, schema, target,
                            f"{location}/{target}" if location else None, validate_only)
        out = row if out is None else out.unionByName(row)
    return out
