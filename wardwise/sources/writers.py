"""Writers of tables, feature lists, result sets and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwise.sources import readers, schemas

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write CSV with a header, or parquet; train, val and test go to folders by ``split``."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # An empty string and a null stay different, and blanks are kept.
        writer = writer.options(header=True, nullValue="NULL", emptyValue='""',
                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_features_json(selected: DataFrame, path: str) -> str:
    """Selected features (method, rank, feature) as one object ``{method: [feature, ...]}``.

    A selection holds at most methods x top_n names.
    """
    per_method = selected.groupBy("method").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))),
                    lambda s: s["feature"]).alias("features"))
    whole = per_method.agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("method", "features"))))).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)
    return path


def create_tables(spark: SparkSession, location: str | None = None,
                  prefix: str = "") -> list[str]:
    """The four stored tables, where absent. Keys are checked by ``key_checks``, not enforced."""
    names = []
    for name, schema in schemas.TABLES.items():
        table = f"{prefix}{name}"
        if not spark.catalog.tableExists(table):
            options = {"path": f"{location}/{table}"} if location else {}
            spark.catalog.createTable(table, source="parquet", schema=schema, **options)
        names.append(table)
    return names


def save_dataframe(df: DataFrame, table: str, if_exists: str = "replace",
                   path: str | None = None) -> None:
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    writer = df.write.mode(MODES[if_exists]).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def save_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append",
              properties: dict | None = None) -> None:
    df.write.jdbc(url, table, mode=MODES[if_exists], properties=properties or {})


def append_model_results(results: DataFrame, table: str) -> None:
    """Append training results in one job; the time is set here, ids are unique, not consecutive."""
    metrics = ["accuracy", "precision", "recall", "f1_score", "auc_score"]
    results.select(
        F.xxhash64(F.uuid()).alias("id"), "model_name", "feature_selection_method",
        F.col("top_n_features").cast("int").alias("top_n_features"),
        *[F.col(m).cast("decimal(5,4)").alias(m) for m in metrics],
        F.current_timestamp().alias("created_at")).write.mode("append").format("parquet").saveAsTable(table)


def append_model_result(spark: SparkSession, result: dict, table: str) -> None:
    """Append one training result."""
    append_model_results(spark.createDataFrame([result]), table)


def write_result_sets(sets: dict[tuple[str, str, str], DataFrame], path: str) -> str:
    """Result sets keyed by (analysis, fs, kind), one folder each."""
    for key, df in sets.items():
        df.write.mode("overwrite").parquet(readers.result_folder(path, *key))
    return path


def csv_to_table(spark: SparkSession, csv_path: str, table: str, schema, if_exists: str = "replace",
                 location: str | None = None) -> None:
    """Load one CSV into a stored table as it is."""
    save_dataframe(readers.read_encounters(spark, csv_path, schema), table, if_exists, location)
