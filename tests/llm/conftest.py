import pytest
from llm_cases import SCHEMA, rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
