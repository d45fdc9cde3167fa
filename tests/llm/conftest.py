import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame of rows, also of none."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
