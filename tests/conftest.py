"""One local session, the small trip and zone fixtures, and a fresh folder per test."""

import os
import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

os.environ["TZ"] = "UTC"
time.tzset()

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from starmart import contracts  # noqa: E402

# The trips, zones and invalid rows that results are stated for.
TRIPS = [
    (1, datetime(2023, 1, 15, 10, 30), datetime(2023, 1, 15, 10, 45),
     2, 3.5, 161, 237, 1, "N", 1, 15.50, 1.0, 0.5, 0.3, 3.0, 0.0, 20.30, 2.5, 0.0),
    (2, datetime(2023, 1, 15, 14, 0), datetime(2023, 1, 15, 14, 30),
     1, 8.2, 138, 265, 1, "N", 2, 28.00, 0.0, 0.5, 0.3, 0.0, 6.55, 35.35, 2.5, 0.0),
    (1, datetime(2023, 1, 16, 8, 15), datetime(2023, 1, 16, 8, 45),
     3, 5.1, 237, 161, 1, "N", 1, 22.00, 2.5, 0.5, 0.3, 5.0, 0.0, 30.30, 2.5, 0.0),
    (1, datetime(2023, 1, 16, 9, 0), datetime(2023, 1, 16, 9, 5),
     1, 0.0, 161, 161, 1, "N", 1, 5.00, 0.0, 0.5, 0.3, 1.0, 0.0, 6.80, 2.5, 0.0),
    (2, datetime(2023, 1, 17, 6, 0), datetime(2023, 1, 17, 7, 30),
     2, 45.0, 132, 265, 2, "N", 1, 150.00, 0.0, 0.5, 0.3, 30.0, 12.0, 195.30, 0.0, 1.75),
]
ZONES = [
    (1, "EWR", "Newark Airport", "EWR"),
    (132, "Queens", "JFK Airport", "Airports"),
    (138, "Queens", "LaGuardia Airport", "Airports"),
    (161, "Manhattan", "Midtown Center", "Yellow Zone"),
    (237, "Manhattan", "Upper East Side South", "Yellow Zone"),
    (265, "Queens", "Astoria", "Boro Zone"),
]
INVALID = [
    (1, datetime(2023, 1, 15, 10, 0), datetime(2023, 1, 15, 10, 15), 1, 2.0, 161, 237, 1, "N", 1,
     -5.00, 0.0, 0.5, 0.3, 0.0, 0.0, -4.20, 0.0, 0.0),
    (1, datetime(2030, 1, 15, 10, 0), datetime(2030, 1, 15, 10, 15), 1, 2.0, 161, 237, 1, "N", 1,
     10.00, 0.0, 0.5, 0.3, 0.0, 0.0, 10.80, 0.0, 0.0),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(TRIPS, contracts.RAW_TRIPS)


@pytest.fixture
def invalid_trips(spark):
    return spark.createDataFrame(INVALID, contracts.RAW_TRIPS)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(ZONES, contracts.ZONES)
