import pytest

from sigloom.llm.shared import importable


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def table(spark):
    """A small table with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(rows, schema, *clashing):
        df = spark.createDataFrame(rows, schema)
        for c in clashing:
            df = df.withColumn(c, F.lit("clash"))
        return df

    return make
