import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from samples import TESTDATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("skyledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from skyledger.plans.catalog import Inputs

    return Inputs(spark, f"{TESTDATA}/sf0.001")


@pytest.fixture(scope="session")
def medium(spark):
    from skyledger.plans.catalog import Inputs

    return Inputs(spark, f"{TESTDATA}/sf0.01")


@pytest.fixture
def raw_rows(spark):
    """Raw records from a few given fields; the rest is one ordinary completed flight."""
    from skyledger import contract as C

    ordinary = {
        "YEAR": "2025", "MONTH": "1", "DAY_OF_WEEK": "3", "FL_DATE": "1/1/2025 12:00:00 AM", "OP_UNIQUE_CARRIER": "AA",
        "OP_CARRIER_AIRLINE_ID": "19805", "TAIL_NUM": "N1", "OP_CARRIER_FL_NUM": "10", "ORIGIN_AIRPORT_ID": "1",
        "ORIGIN_AIRPORT_SEQ_ID": "1", "ORIGIN_CITY_MARKET_ID": "1", "ORIGIN": "JFK", "ORIGIN_CITY_NAME": "New York, NY",
        "DEST_AIRPORT_ID": "2", "DEST_AIRPORT_SEQ_ID": "2", "DEST_CITY_MARKET_ID": "2", "DEST": "MVY",
        "DEST_CITY_NAME": "Martha's Vineyard, MA", "CRS_DEP_TIME": "0930", "DEP_TIME": "0930", "DEP_DELAY": "0.00",
        "DEP_DEL15": "0.00", "CRS_ARR_TIME": "1030", "ARR_TIME": "1030", "ARR_DELAY": "0.00", "ARR_DELAY_NEW": "0.00",
        "ARR_DEL15": "0.00", "CANCELLED": "0.00", "CANCELLATION_CODE": None, "DIVERTED": "0.00", "DISTANCE": "173.00",
        **{c: None for c in C.CAUSE_COLUMNS},
        "_source_file": "ontime_2025_01.csv", "_source_year": 2025, "_source_month": 1,
    }

    def build(*changes):
        rows = [tuple({**ordinary, **change}.values()) for change in changes]
        return spark.createDataFrame(rows, C.raw_with_lineage_schema())

    return build


@pytest.fixture
def flight(raw_rows):
    """Cleaned records from a few given raw fields."""
    from skyledger.operators.cleaning import clean_flights

    return lambda *changes: clean_flights(raw_rows(*changes))
