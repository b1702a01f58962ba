import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # extra columns whose names the operators use themselves
                     T.StructField("ids", T.StringType()), T.StructField("score", T.DoubleType()),
                     T.StructField("host", T.StringType()), T.StructField("label", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text[, lang[, source]])"""
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), "x", 0.5, "h", "l") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


LONG = "alpha beta gamma delta " * 9_000
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "null id text here"), (4, "same text"),
       (4, "same text"), (5, LONG), (6, "日本語 ünïcödé 😀 \x00 \x1c \u00a0 end"), (7, "...!?"),
       (8, "a")]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs([(i, t, "en", None if i == 8 else "s") for i, t in ODD])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
