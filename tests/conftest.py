import os
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shoplake import schemas  # noqa: E402
from shoplake.workspace import tune  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shoplake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def events(spark):
    """Builds event rows; every field has a valid default."""
    def build(*overrides):
        base = {
            "event_time": datetime(2024, 1, 1, 10), "event_type": "view", "product_id": 1,
            "category_id": 5, "category_code": "toys", "brand": "acme", "price": "9.99",
            "user_id": 7, "user_session": "s1",
        }
        rows = []
        for change in overrides:
            row = {**base, **change}
            if row["price"] is not None:
                row["price"] = Decimal(str(row["price"]))
            rows.append(tuple(row[c] for c in schemas.EVENT_COLUMNS))
        return spark.createDataFrame(rows, schemas.EVENT)

    return build


@pytest.fixture
def messages(spark):
    """Kafka-shaped rows out of JSON texts; the offset is the position."""
    def build(*values, start=0, at=datetime(2024, 1, 1)):
        rows = [
            (None, None if v is None else bytearray(v.encode()), "t", 0, start + n, at)
            for n, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, schemas.KAFKA_ROW)

    return build
