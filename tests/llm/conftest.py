import pytest
from brute import SCHEMA, odd_documents


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
