from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


def make_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("hearthlog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    from hearthlog.config import configure_session

    return configure_session(make_session())


@pytest.fixture
def log_of(spark):
    """Build a device log from partial rows; unnamed fields get defaults."""
    from pyspark.sql import functions as F

    from hearthlog.schemas import DEVICE_LOG
    from hearthlog.sources.device_log import with_event_time

    defaults = {
        "productKey": "P1",
        "iotId": "iot1",
        "deviceName": "d1",
        "gmtCreate": 1667491200000,
        "eventOriValue": "",
    }

    def build(*rows: dict):
        names = DEVICE_LOG.names
        data = [tuple({**defaults, **row}.get(n) for n in names) for row in rows]
        return with_event_time(spark.createDataFrame(data, DEVICE_LOG).select(*map(F.col, names)))

    return build


@pytest.fixture
def dictionary_of(spark):
    """Build a fault dictionary from (type, product, code, name) rows."""
    from hearthlog.schemas import FAULT_DICTIONARY

    return lambda *rows: spark.createDataFrame(list(rows), FAULT_DICTIONARY)
