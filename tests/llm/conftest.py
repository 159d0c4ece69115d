"""Shared data folder and helpers of these tests."""

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def documents(spark):
    return [r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
