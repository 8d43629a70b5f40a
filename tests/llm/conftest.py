import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """documents from (doc_id, text) pairs, in two partitions."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOCS).repartition(2)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
