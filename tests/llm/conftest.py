import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType())])


@pytest.fixture
def make_docs(spark):
    """(doc_id, text, source) rows -> DataFrame, with columns whose names clash with the operators' own."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(r + (None,) * 3)[:3] for r in rows], DOCS)
        if clash:
            df = df.selectExpr("*", *[f"'x' AS {c}" for c in ("size", "h", "target", "copies", "fp", "component_id", "score",
                                                               "ids", "n_entities", "part", "root")])
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, white space, ties, repeated rows, a very long text, other scripts."""
    return [(None, None, None), (None, "", "b"), (1, "", "a"), (2, None, "a"), (3, " \t\n", "a"), (4, "one two three", "a"),
            (4, "one two three", "a"), (5, "one two three", None), (6, "word " * 40_000, "b"), (7, "x" * 50_000, "é"),
            (8, "日本 語 ▁ text", "b"), (9, "one two three four five six", "a"), (10, "One TWO three four five six", "b")]
