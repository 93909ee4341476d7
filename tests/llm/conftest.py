"""Small corpora with the cases every operator has to stand."""

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import corpus  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType()), T.StructField("k1", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "clash", "clash", "clash", len(t or ""), "clash") for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
