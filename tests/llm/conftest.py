from __future__ import annotations

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
def frame(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, dealt over some partitions."""

    def make(rows, parts=3, **extra):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "s"][len(r) - 2 :]), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        for name, value in extra.items():
            df = df.withColumn(name, value)
        return df

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r["doc_id"]: r["text"] for r in corpus.select("doc_id", "text").collect()}
