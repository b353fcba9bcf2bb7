import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def samples_from(spark):
    """Samples in stream order from ``(label, feature)`` pairs."""

    def build(pairs, batch_id=0):
        rows = [
            ("t", 0, i, 0, float(y), float(x), batch_id) for i, (y, x) in enumerate(pairs)
        ]
        return spark.createDataFrame(
            rows,
            "topic string, partition int, offset long, pos int, label double,"
            " feature double, batch_id long",
        )

    return build
