import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("spark"))
    session = local_session(
        4, "opsmart-tests",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=f"{folder}/checkpoint",
        spark__sql__warehouse__dir=f"{folder}/warehouse",
    )
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over hand-written rows, in row order."""
    from pyspark.sql import functions as F

    def run(rows, schema, expression):
        data = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(data, f"__i int, {schema}").select("__i", expression.alias("__x"))
        return [r["__x"] for r in df.orderBy(F.col("__i")).collect()]

    return run


@pytest.fixture
def many_ranges(spark):
    """Keep small tables in several partitions, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)
