import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    """(id, text[, lang[, source]]) rows → a documents table."""

    def make(rows):
        full = []
        for r in rows:
            r = tuple(r) + ("en", "src0")[len(r) - 2 :]
            full.append((*r, None if r[1] is None else len(r[1])))
        return spark.createDataFrame(full, DOCS)

    return make
