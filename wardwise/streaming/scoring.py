"""Batch scoring of files as they arrive, with the same saved scorer."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardwise.operators.train import batch_score


def score_new_files(spark: SparkSession, scorer: PipelineModel, source: str, schema: T.StructType,
                    target: str, checkpoint: str,
                    files_per_batch: int = 1000) -> StreamingQuery:
    """Score the files not scored before and append them to ``target``, then stop.

    The checkpoint, a shared folder of this job's own, remembers the files, so a rerun with it or a
    lost executor neither skips nor repeats.
    """
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(source))
    return (batch_score(scorer, rows).writeStream.format("parquet").outputMode("append")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
