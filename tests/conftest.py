import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evlake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return configure(session)


@pytest.fixture
def topic_of(spark):
    """Topic messages from payloads: text, bytes or None, offsets counting up."""
    from evlake.schema import TOPIC

    def make(payloads, partitions=1):
        import datetime as dt

        when = dt.datetime(2025, 3, 9, 18, 0, 0)
        rows = []
        for i, p in enumerate(payloads):
            value = p.encode() if isinstance(p, str) else p
            rows.append(("t", i % partitions, i // partitions, value, when))
        return spark.createDataFrame(rows, TOPIC)

    return make
