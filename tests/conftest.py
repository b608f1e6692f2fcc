import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from telepulse.session import build_session

    session = build_session(
        "telepulse-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Telemetry rows from dictionaries, with usable values for what is left out."""
    from telepulse.functions.calendar import with_partition_columns
    from telepulse.schema import PARTITION_COLUMNS, TELEMETRY_COLUMNS, TELEMETRY_CSV_DDL

    usual = {
        "device_id": "R-1",
        "fleet_id": "F-1",
        "event_time": "2026-03-20 12:00:00",
        "battery_level": 50,
        "speed_mps": 1.0,
        "status": "ACTIVE",
        "error_code": None,
        "location_zone": "Z-1",
        "temperature_celsius": 25.0,
    }

    def rows(*changes):
        values = [tuple({**usual, **change}[c] for c in TELEMETRY_COLUMNS) for change in changes]
        df = spark.createDataFrame(values, TELEMETRY_CSV_DDL)
        df = with_partition_columns(df.withColumn("event_time", df.event_time.cast("timestamp")))
        return df.select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS)

    return rows


def only(df):
    """The single row of a frame, as a dictionary."""
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict(recursive=True)
