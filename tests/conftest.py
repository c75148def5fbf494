import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import termlode as tl  # noqa: E402
from helpers import CORPUS, SF_DIR, make_docs  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs(spark):
    return make_docs(spark, CORPUS).cache()


@pytest.fixture(scope="session")
def index(docs):
    return tl.build_index(docs).cache()


@pytest.fixture(scope="session")
def real_docs(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return tl.corpus_from_table(table, "lang", "doc_id", "text").cache()


@pytest.fixture(scope="session")
def real_index(real_docs):
    return tl.build_index(real_docs).cache()
