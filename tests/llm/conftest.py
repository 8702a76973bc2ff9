import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""
    def make(rows):
        full = [(*r, "en", "s")[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCUMENTS)

    return make
