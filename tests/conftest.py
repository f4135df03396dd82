import datetime as dt
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("roadlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="roadlake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from roadlake.session import scratch_path

    return scratch_path(spark, "test")


def event(vehicle="V1001", timestamp=1704067200.5, **changes):
    """One well-formed event as a tuple in schema order."""
    from roadlake.schema import EVENT_COLS

    fields = {
        "vehicle_id": vehicle,
        "number_plate": "MH 12 AB 1234",
        "vehicle_type": "car",
        "vehicle_name": "Honda City",
        "speed": 80.0,
        "location_lat": 18.75,
        "location_lon": 73.85,
        "user_id": 7,
        "phone_number": "912345678",
        "car_life_years": 3,
        "price_of_vechical": 500000.0,
        "fine": 0,
        "timestamp": timestamp,
    } | changes
    return tuple(fields[c] for c in EVENT_COLS)


def at(text):
    return dt.datetime.fromisoformat(text)
