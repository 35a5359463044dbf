"""Fixtures of the corpus tests."""

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
def docs(spark):
    """Documents of (doc_id, text), with the other columns filled."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing():
    """The same frame with columns that operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        for name in ("n", "rank", "spans", "at", "label", "grp", "doc", "items", "gone", "kept"):
            df = df.withColumn(name, F.lit("other"))
        return df

    return add

