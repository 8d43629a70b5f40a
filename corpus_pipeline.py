"""The corpus pipeline: stages over the documents table, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwise.llm import decontaminate, jaccard, quality, secrets, sentencepiece
from wardwise.llm.rows import text_id, without
from wardwise.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the others stay as they are."""
    rules = quality.fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # written first: a filter on `kept` would be pushed down as one vast expression
    judged = materialize(quality.apply_rules(docs.withColumn("text_id", text_id()), rules)
                         .select("doc_id", "text_id", "kept"), "judged")
    return without(docs, judged.where("NOT kept"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.first_of_groups(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark windows go."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, materialize(found.where("contaminated").select("doc_id", "text_id"), "contaminated"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; n_chars follows the new text."""
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def sentencepiece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: piece_ids, n_pieces, and whether decoding them gives the text back."""
    vocab = sentencepiece.load_vocabulary()
    coded = sentencepiece.decode(sentencepiece.encode(docs, vocab), vocab)
    return coded.select(*docs.columns, "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_coding", sentencepiece_coding),
]
#: SQL states neither the fitted rules nor the pieces; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
