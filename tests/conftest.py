import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tillcast-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows from literal tuples, with text cast to the declared types."""

    def make(ddl, *values):
        from pyspark.sql import functions as F
        from pyspark.sql.types import StringType, StructField, StructType

        schema = StructType.fromDDL(ddl)
        text = StructType([StructField(f.name, StringType()) for f in schema.fields])
        raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in row) for row in values], text)
        return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    return make


@pytest.fixture
def shared(spark, tmp_path):
    return str(tmp_path)
