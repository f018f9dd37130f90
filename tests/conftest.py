import datetime as dt
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ridemart.session import local_session  # noqa: E402
from ridemart.sources.schema import RAW_TRIPS  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "ridemart-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from ridemart.plans.catalog import Inputs

    return Inputs(spark, DATA)


GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 1, 8, 8, 0, 30),
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 8, 8, 15, 10),
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1.0,
    "PULocationID": 161,
    "DOLocationID": 237,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "total_amount": 16.0,
    "congestion_surcharge": 2.5,
}


@pytest.fixture
def make_trips(spark):
    """Raw trips from a list of changes to one good trip."""

    def make(*changes):
        rows = [tuple({**GOOD_TRIP, **c}[f.name] for f in RAW_TRIPS.fields) for c in changes]
        return spark.createDataFrame(rows, RAW_TRIPS)

    return make
