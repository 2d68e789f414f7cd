import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from awkward_tables import documents, story  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    long = " ".join(story(3000, 5))
    base = " ".join(story(60, 1))
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (None, "a text without id"), (None, None),
            (6, long), (7, "x" * 5000), (8, "one"), (9, "one two"), (10, " ".join(story(60, 2)) + "\n" + base),
            (11, "é ü  日本 \U0001f642 \x01 z"), (12, "one two")]
    return rows, documents(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [(1, "x")]).where("doc_id < 0")


@pytest.fixture(scope="session")
def small_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()], df
