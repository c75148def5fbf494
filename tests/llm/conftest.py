import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from brute import SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """``(doc_id, text)`` of the smallest table."""
    return [(row["doc_id"], row["text"]) for row in documents.select("doc_id", "text").collect()]
