import pytest

from llm_helpers import ODD, SCHEMA
from saleswright.llm.common import workers_import_package

@pytest.fixture(autouse=True)
def _importable(spark):
    workers_import_package(spark)


@pytest.fixture
def odd(spark):
    """The odd rows over several partitions."""
    rows = [(i, t, "r", "R", 5, "d", "b", "k", "i", "w", "x", "n", "t") for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)

