import os
import sys

import pytest
from trip_rows import TRIP_SCHEMA, trip_rows

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallygate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_trips(spark):
    return lambda rows: spark.createDataFrame(trip_rows(rows), TRIP_SCHEMA)


@pytest.fixture
def city(spark):
    """265 zones: 264 and 265 unknown, 132 and 138 airports, 1 another airport."""
    return spark.range(1, 266).selectExpr(
        "cast(id as int) AS zone_id",
        "CASE WHEN id = 264 THEN 'Unknown' WHEN id = 265 THEN 'N/A' WHEN id <= 100 THEN 'Queens' "
        "ELSE 'Manhattan' END AS borough",
        "concat('Z', id) AS zone",
        "CASE WHEN id IN (132, 138) THEN 'Airports' WHEN id = 1 THEN 'EWR' ELSE 'Boro Zone' END "
        "AS service_zone",
    )
