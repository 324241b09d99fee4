"""Fixtures of the training-data operators' tests."""
import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """(id, text) pairs as a documents table."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOC).repartition(3)
    return make


@pytest.fixture
def clashing():
    """Adds columns with the names that operators use inside."""
    from pyspark.sql import functions as F
    names = ("content", "weight", "name", "n", "key", "quality", "toxic", "_digest", "_chars", "_name", "_noise", "_gone_id", "_l", "_d", "_c", "node", "root", "host", "salt", "kept", "held_out")
    return lambda df: df.withColumns({c: F.lit("x") for c in names if c not in df.columns})
