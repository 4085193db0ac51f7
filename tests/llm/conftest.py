import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Small table from tuples and a schema, dealt over a few partitions."""
    def make(data, schema, parts=3):
        return spark.createDataFrame(data, schema).repartition(parts)
    return make
