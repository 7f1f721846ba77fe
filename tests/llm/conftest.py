import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A table of rows with a schema, given as text."""
    from adjudica.llm.common import importable

    importable(spark)

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
