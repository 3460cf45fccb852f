import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """make_docs([(doc_id, text) or (doc_id, text, lang)]) -> documents."""
    def make(rows):
        full = [(i, x, (more or ["en"])[0], "src", None if x is None else len(x)) for i, x, *more in rows]
        return spark.createDataFrame(full, DOCS)
    return make
