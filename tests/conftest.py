import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from paywatch.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "paywatch-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = datetime(2024, 1, 1)


def rows_to_txns(spark, rows):
    """(id, user, minute, amount, device, location) tuples as a transaction table."""
    data = [
        (i, u, None if m is None else START + timedelta(minutes=m), a, d, l) for i, u, m, a, d, l in rows
    ]
    return spark.createDataFrame(
        data,
        "transaction_id long, user_id long, timestamp timestamp, amount double, device_type string, location string",
    )


@pytest.fixture
def txns(spark):
    return lambda rows: rows_to_txns(spark, rows)


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
