"""Queries of sources and sinks: each writes data of the tables and reads it back."""

import uuid

from pyspark.sql import functions as F

from wardwise.operators import migration, suite
from wardwise.plans.registry import register
from wardwise.plans.suite_queries import RATE
from wardwise.session import materialize, scratch_path
from wardwise.sources import readers, writers


def _round_trip(c, fmt):
    path = scratch_path(c.spark, "encounters") + (".parquet" if fmt == "parquet" else "")
    writers.write_table(c.encounters, path, fmt)
    return readers.read_encounters(c.spark, path, c.encounters.schema)


register("read_encounters_csv", lambda c: _round_trip(c, "csv"), "SELECT * FROM {encounters}")
register("read_encounters_parquet", lambda c: _round_trip(c, "parquet"),
         "SELECT * FROM {encounters}")


def _partitioned(c):
    path = writers.write_table(c.scored, scratch_path(c.spark, "scored"), partition_by=["split"])
    return c.spark.read.parquet(path)


register("write_table_by_split", _partitioned, "SELECT * FROM {scored}")


def _lookup_lines(c):
    """The three lookups stacked into one file, as a hospital export has them."""
    parts = [("admission_type_id", c.admission_type), ("discharge_disposition_id",
                                                       c.discharge_disposition),
             ("admission_source_id", c.admission_source)]
    stacked = None
    for i, (key, df) in enumerate(parts):
        text = F.concat_ws(",", F.col(key).cast("string"),
                           F.coalesce(F.col(df.columns[1]), F.lit("NULL")))
        rows = df.select(F.lit(i).alias("part"), F.col(key).alias("seq"), text.alias("line"))
        heads = c.region.groupBy().agg(F.count("*")).select(
            F.lit(i).alias("part"), F.explode(F.array(F.lit(-1), F.lit(-2))).alias("seq"))
        heads = heads.withColumn("line", F.when(F.col("seq") == -1, f"{key},description")
                                 .otherwise(","))
        both = rows.unionByName(heads)
        stacked = both if stacked is None else stacked.unionByName(both)
    path = scratch_path(c.spark, "lookup")
    stacked.coalesce(1).sortWithinPartitions("part", "seq").select("line").write.text(path)
    return readers.read_code_lookup(c.spark, path)


register("read_code_lookup", _lookup_lines, """
WITH parts AS (
  SELECT 0 AS part, admission_type_id AS seq, admission_type_id || ',' || COALESCE(admission_type_desc, 'NULL') AS line
  FROM {admission_type}
  UNION ALL SELECT 1, discharge_disposition_id, discharge_disposition_id || ',' || discharge_disposition_desc
  FROM {discharge_disposition}
  UNION ALL SELECT 2, admission_source_id, admission_source_id || ',' || admission_source_desc FROM {admission_source}
  UNION ALL SELECT p, -2, ',' FROM range(3) t(p)
  UNION ALL SELECT p, -1, ['admission_type_id', 'discharge_disposition_id', 'admission_source_id'][p + 1] || ',description'
  FROM range(3) t(p))
SELECT CAST(ROW_NUMBER() OVER (ORDER BY part, seq) - 1 AS INT) AS line_number, line FROM parts""")


def _split(c):
    found = readers.split_code_lookup(_lookup_lines(c))
    out = None
    for key, df in found.items():
        part = df.select(F.lit(key).alias("lookup"), F.col(key).alias("id"),
                         F.col(df.columns[1]).alias("description"))
        out = part if out is None else out.unionByName(part)
    return out


register("split_code_lookup", _split, """
SELECT 'admission_type_id' AS lookup, admission_type_id AS id, admission_type_desc AS description
FROM {admission_type}
UNION ALL SELECT 'discharge_disposition_id', * FROM {discharge_disposition}
UNION ALL SELECT 'admission_source_id', * FROM {admission_source}""")


def _ccs_rows(c):
    path = scratch_path(c.spark, "ccs")
    rows = c.encounters.filter("diag_1 <> '?'").groupBy("diag_1").agg(F.count("*").alias("n"))
    table = rows.select(F.concat(F.lit(" "), "diag_1").alias("ICD9_Code"),
                        F.substring("diag_1", 1, 1).alias("CCS_Category"),
                        F.concat(F.lit("group "), "diag_1").alias("CCS_Desc"),
                        F.col("n").cast("string").alias("ICD9_Desc"))
    writers.write_table(table, path, "csv")
    return readers.read_ccs(c.spark, path)


register("read_ccs", _ccs_rows, """
SELECT diag_1 AS "ICD9_Code", substr(diag_1, 1, 1) AS "CCS_Category",
  'group ' || diag_1 AS "CCS_Desc", CAST(COUNT(*) AS VARCHAR) AS "ICD9_Desc"
FROM {encounters} WHERE diag_1 <> '?' GROUP BY diag_1""")


def _features_json(c):
    """Most frequent diagnoses per model name stand for the selected features."""
    picked = (c.model_results.groupBy(F.col("feature_selection_method").alias("method"),
                                      F.concat("model_name", F.lit("_"), "top_n_features")
                                      .alias("feature"))
              .agg(F.max(F.struct("auc_score", "id")).alias("best")))
    rank = F.expr("row_number() OVER (PARTITION BY method ORDER BY best DESC)")
    path = writers.write_features_json(picked.select("method", "feature", rank.alias("rank")),
                                       scratch_path(c.spark, "features"))
    return readers.read_features_json(c.spark, path)


register("features_json", _features_json, """
WITH p AS (SELECT feature_selection_method AS method,
  model_name || '_' || top_n_features AS feature, MAX(struct_pack(a := auc_score, i := id)) AS best
  FROM {model_results} GROUP BY 1, 2)
SELECT method, CAST(ROW_NUMBER() OVER (PARTITION BY method ORDER BY best DESC) AS INT) AS rank,
  feature FROM p""")


def _dropped(c, df, *tables):
    """The rows, written once, with the catalog tables that they were read from dropped."""
    out = materialize(df, "rows")
    for table in tables:
        c.spark.sql(f"DROP TABLE IF EXISTS {table}")
    return out


def _create(c):
    place, prefix = scratch_path(c.spark, "store"), f"t{uuid.uuid4().hex[:10]}_"
    writers.create_tables(c.spark, place, prefix)
    key = F.col("encounter_id").cast("string")
    stays = c.encounters.select(key.alias("encounter_id"), F.col("patient_nbr").cast("string").alias("patient_id"),
                                F.col("created_at").cast("date").alias("encounter_date"),
                                F.lit("inpatient").alias("encounter_type"), "created_at")
    drugs = c.medications.withColumn("id", F.xxhash64("patient_id", "medication_name")).withColumn(
        "created_at", F.lit(None).cast("timestamp"))
    filled = {"patients": c.patients, "encounters": stays, "medications": drugs, "model_results": c.model_results}
    out = None
    for name, df in filled.items():
        stored = c.spark.table(f"{prefix}{name}")
        df.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema]).write.insertInto(f"{prefix}{name}")
        c.spark.catalog.refreshTable(f"{prefix}{name}")
        rows = c.spark.table(f"{prefix}{name}")
        # what every stored row holds, but for the ids that the writer makes
        cells = F.concat_ws("|", *[F.col(n).cast("string") for n in _STORED[name]])
        part = rows.select(F.lit(name).alias("table_name"), cells.alias("cells"))
        out = part if out is None else out.unionByName(part)
    return _dropped(c, out, *(f"{prefix}{name}" for name in filled))


_STORED = {
    "patients": ["patient_id", "age", "gender", "race", "admission_type_id", "discharge_disposition_id",
                 "admission_source_id", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
                 "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3", "readmitted"],
    "encounters": ["encounter_id", "patient_id", "encounter_date", "encounter_type"],
    "medications": ["patient_id", "medication_name", "dosage_change"],
    "model_results": ["id", "model_name", "feature_selection_method", "top_n_features", "auc_score"],
}


def _cells_sql(name: str, **other: str) -> str:
    cells = ", ".join(f"CAST({other.get(n, n)} AS VARCHAR)" for n in _STORED[name])
    return f"SELECT '{name}' AS table_name, concat_ws('|', {cells}) AS cells FROM {{{name}}}"


register("create_tables", _create, " UNION ALL ".join([
    _cells_sql("patients"),
    _cells_sql("encounters", patient_id="patient_nbr", encounter_date="CAST(created_at AS DATE)", encounter_type="'inpatient'"),
    _cells_sql("medications"),
    _cells_sql("model_results", auc_score="CAST(auc_score AS DECIMAL(5, 4))")]))


def _save(c):
    place, table = scratch_path(c.spark, "saved"), f"t{uuid.uuid4().hex[:10]}_saved"
    writers.save_dataframe(c.medications, table, "fail", place)
    writers.save_dataframe(c.medications, table, "append")
    return _dropped(c, c.spark.table(table).groupBy("medication_name", "dosage_change").agg(
        F.count("*").alias("n")), table)


register("save_dataframe", _save, """
SELECT medication_name, dosage_change, 2 * COUNT(*) AS n FROM {medications} GROUP BY 1, 2""")


def _append(c):
    """Append the best stored run of each model as a new result."""
    place, prefix = scratch_path(c.spark, "results"), f"t{uuid.uuid4().hex[:10]}_"
    writers.create_tables(c.spark, place, prefix)
    writers.append_model_results(suite.best_models(c.model_results), f"{prefix}model_results")
    rows = c.spark.table(f"{prefix}model_results").drop("id", "created_at").select(
        "model_name", "feature_selection_method", "top_n_features",
        *[F.col(m).cast("double").alias(m) for m in suite._METRICS])
    return _dropped(c, rows, *(f"{prefix}{name}" for name in _STORED))


register("append_model_result", _append, """
WITH ranked AS (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY auc_score DESC, id) AS by_auc,
  ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY f1_score DESC, id) AS by_f1
  FROM {model_results})
SELECT model_name, feature_selection_method, top_n_features, accuracy, precision, recall, f1_score,
  auc_score FROM ranked WHERE by_auc = 1 OR by_f1 = 1""")


def _result_sets(c):
    path = scratch_path(c.spark, "result-sets")
    sets = {}
    for fs in ("L1", "MutualInfo", "TreeImportance"):
        rows = c.model_results.filter(F.col("feature_selection_method") == fs)
        sets["Main", fs, "val"] = rows.select("id", "model_name", "auc_score")
        sets["Main", fs, "test"] = rows.select("id", "model_name", "f1_score")
    writers.write_result_sets(sets, path)
    out = None
    for (_, fs, kind), df in sets.items():
        part = readers.read_result_set(c.spark, path, "Main", fs, kind).select(
            F.lit(fs).alias("fs"), F.lit(kind).alias("kind"), "id", "model_name", F.col(df.columns[2]).alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


register("result_sets", _result_sets, """
SELECT feature_selection_method AS fs, 'val' AS kind, id, model_name, auc_score AS score FROM {model_results}
UNION ALL SELECT feature_selection_method, 'test', id, model_name, f1_score FROM {model_results}""")
register("run_sql",
         lambda c: readers.run_sql(c.spark, """
SELECT gender, count_if(readmitted = :cls) AS n FROM {patients}
WHERE time_in_hospital >= :days GROUP BY gender""", {"cls": "<30", "days": 5}, patients=c.patients),
         "SELECT gender, COUNT(*) FILTER (WHERE readmitted = '<30') AS n FROM {patients} "
         "WHERE time_in_hospital >= 5 GROUP BY gender")


def _files(c):
    files = {}
    for name in ("patients", "medications", "model_results"):
        df = getattr(c, name)
        path = writers.write_table(df, scratch_path(c.spark, name), "csv")
        files[name] = (path, df.schema)
    return files


def _csv_to_table(c):
    path, schema = _files(c)["patients"]
    table = f"t{uuid.uuid4().hex[:10]}_loaded"
    writers.csv_to_table(c.spark, path, table, schema, location=scratch_path(c.spark, "loaded"))
    return suite.readmission_stats(c.spark.table(table))


register("csv_to_table", _csv_to_table, f"""
SELECT age, gender, COUNT(*) AS total_patients,
  COUNT(*) FILTER (WHERE readmitted = '<30') AS early_readmissions,
  COUNT(*) FILTER (WHERE readmitted = '>30') AS late_readmissions,
  COUNT(*) FILTER (WHERE readmitted = 'NO') AS no_readmissions, {RATE} AS early_readmission_rate
FROM {{patients}} GROUP BY 1, 2""")
register("migrate_all",
         lambda c: migration.migrate_all(c.spark, _files(c), f"t{uuid.uuid4().hex[:10]}_",
                                         scratch_path(c.spark, "migrated")), """
SELECT 'patients' AS table_name, COUNT(*) AS rows_read, COUNT(*) AS rows_loaded, TRUE AS is_valid,
  TRUE AS success FROM {patients}
UNION ALL SELECT 'medications', COUNT(*), COUNT(*), TRUE, TRUE FROM {medications}
UNION ALL SELECT 'model_results', COUNT(*), COUNT(*), TRUE, TRUE FROM {model_results}""")
