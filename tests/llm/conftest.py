import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs or from texts."""
    def build(texts, extra=None):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        docs = spark.createDataFrame(rows, SCHEMA)
        return docs if extra is None else docs.withColumns(extra)
    return build
