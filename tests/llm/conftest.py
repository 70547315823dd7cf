import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest_llm import EDGES  # noqa: E402

@pytest.fixture(scope="session")
def edges(spark):
    """Documents with NULLs, empty and long texts, ties, repeated rows and columns named like results."""
    rows = [(i, t, "x", 1, "y", b"z", 2.0) for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, spans string, size int, quality string, fingerprint binary, n_words double"
    ).repartition(5)


@pytest.fixture(scope="session")
def documents(spark, data):
    """The whole table at the smallest size and as Python rows."""
    df = spark.read.parquet(data("0.001", "documents"))
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
