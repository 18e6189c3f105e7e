import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from oreline.session import build_session  # noqa: E402
from oreline.spec import STREAM_RECORD  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("sample tables not available")
    return path


@pytest.fixture
def records(spark):
    """Stream records from JSON texts, offsets in the given order."""

    def make(values, topic="cdc.t"):
        rows = [(topic, 0, i, None, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp string, value string")
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).select(*STREAM_RECORD.names)

    return make


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
