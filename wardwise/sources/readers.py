"""Readers of encounters, lookups, feature lists, result sets and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardwise.sources import schemas

LOOKUPS = {
    "admission_type_id": "admission_type_desc",
    "discharge_disposition_id": "discharge_disposition_desc",
    "admission_source_id": "admission_source_desc",
}


def read_encounters(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Encounters from CSV with a header, or from parquet; never inferred."""
    schema = schema or schemas.encounters_schema()
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return spark.read.csv(path, header=True, schema=schema, nullValue="NULL")


def read_ccs(spark: SparkSession, path: str) -> DataFrame:
    """ICD-9 to CCS map with trimmed codes."""
    table = spark.read.csv(path, header=True, schema=schemas.CCS)
    return table.withColumn("ICD9_Code", F.trim("ICD9_Code"))


def read_code_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the stacked lookup file in file order: (line_number, line).

    The file holds a few dozen lines; it is read as one text so that the order is certain.
    """
    text = spark.read.text(path, wholetext=True)
    lines = F.posexplode(F.split("value", r"\r?\n")).alias("line_number", "line")
    return text.select(lines).filter(F.col("line") != "")


def split_code_lookup(lines: DataFrame) -> dict[str, DataFrame]:
    """The three lookups of a stacked file, cut at its header rows and not by position."""
    pair = F.from_csv("line", "id STRING, description STRING", {"nullValue": "NULL"})
    cells = lines.select("line_number", pair.alias("_p")).select("line_number", "_p.*")
    header = F.when(F.col("id").isin(*LOOKUPS), F.col("id"))
    section = F.last(header, ignorenulls=True).over(Window.orderBy("line_number"))
    rows = (cells.withColumn("section", section).withColumn("id", F.col("id").try_cast("int"))
            .filter("id IS NOT NULL"))
    return {name: rows.filter(F.col("section") == name)
            .select(F.col("id").alias(name), F.col("description").alias(text))
            for name, text in LOOKUPS.items()}


def read_features_json(spark: SparkSession, path: str) -> DataFrame:
    """Feature lists ``{method: [feature, ...]}`` as (method, rank, feature)."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", "MAP<STRING, ARRAY<STRING>>").alias("lists"))
    return (parsed.select(F.explode("lists").alias("method", "features"))
            .select("method", F.posexplode("features").alias("rank", "feature"))
            .withColumn("rank", F.col("rank") + 1))


def result_folder(path: str, analysis: str, fs: str, kind: str) -> str:
    return f"{path}/analysis={analysis}/fs={fs}/kind={kind}"


def read_result_set(spark: SparkSession, path: str, analysis: str, fs: str, kind: str) -> DataFrame:
    """One result set; kinds have different columns, so its own folder is read."""
    return spark.read.parquet(result_folder(path, analysis, fs, kind))


def read_jdbc_table(spark: SparkSession, url: str, table: str, key: str, lower, upper,
                    partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """A stored table over JDBC, read in parallel ranges of a numeric or date key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def run_sql(spark: SparkSession, text: str, params: dict | None = None,
            **tables: DataFrame) -> DataFrame:
    """SQL with ``:name`` parameters over the given tables; an invalid statement raises."""
    return spark.sql(text, args=params or {}, **tables)
