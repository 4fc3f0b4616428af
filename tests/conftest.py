import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """A DataFrame of text columns from rows of strings and Nones."""

    def build(columns, *rows):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return build


@pytest.fixture
def values():
    """The first column's values, sorted, NULLs last."""

    def collect(df):
        return sorted((r[0] for r in df.collect()), key=lambda v: (v is None, v))

    return collect
