from datetime import datetime

import pytest
from conftest import only
from pyspark.sql import functions as F

from telepulse.operators import filters, windows
from telepulse.schema import SIX_FIELD_COLUMNS
from telepulse.sources import files

START = 1711525200000  # a five-minute boundary, 07:40:00 UTC


def six_field(spark, *records):
    lines = [(f"{device},{temperature},60,1013,{millis},x",) for device, temperature, millis in records]
    df = files.parse_six_field_lines(spark.createDataFrame(lines, "value string"))
    assert df.columns == SIX_FIELD_COLUMNS
    return windows.window_stats(
        df.withColumn("event_time", F.timestamp_millis("timestamp")), measures=windows.SIX_FIELD_MEASURES
    )


def test_no_records(spark):
    assert six_field(spark, ("A", 20, START)).filter("device_id = 'B'").count() == 0


def test_same_window_is_averaged(spark):
    row = only(six_field(spark, ("A", 20, START), ("A", 30, START + 60_000)))
    assert (row["temperature_avg"], row["temperature_min"], row["temperature_max"]) == (25, 20, 30)
    assert row["record_count"] == 2
    assert row["humidity_avg"] == 60 and row["pressure_max"] == 1013
    assert row["window_start"] == datetime.fromtimestamp(START / 1000)
    assert (row["window_end"] - row["window_start"]).total_seconds() == 300


def test_devices_apart(spark):
    assert six_field(spark, ("A", 20, START), ("B", 20, START)).count() == 2


@pytest.mark.parametrize("offset,groups", [(299_999, 1), (300_000, 2), (360_000, 2)])
def test_windows_are_half_open(spark, offset, groups):
    assert six_field(spark, ("A", 20, START), ("A", 21, START + offset)).count() == groups


@pytest.mark.parametrize(
    "temperature,kept", [(200, 0), (-100, 0), (150, 1), (-50, 1), (150.01, 0), (-50.01, 0), ("NaN", 0), ("", 0)]
)
def test_outliers(spark, temperature, kept):
    assert six_field(spark, ("A", temperature, START)).count() == kept


def test_bad_numbers_become_null(spark):
    lines = spark.createDataFrame([("A,20.5,x,1013,nope,2024",), ("B",)], "value string")
    first, second = files.parse_six_field_lines(lines).collect()
    assert (first.temperature, first.humidity, first.pressure, first.timestamp) == (20.5, None, 1013.0, None)
    assert second.device_id == "B" and second.iso_timestamp is None


def test_previous_hour_bounds(make):
    times = ["11:59:59.999", "12:00:00", "12:59:59.999", "13:00:00"]
    df = make(*[{"event_time": f"2026-03-20 {t}", "device_id": t} for t in times])
    kept = filters.in_previous_hour(df, as_of="2026-03-20 13:25:00").select("device_id").collect()
    assert sorted(r.device_id for r in kept) == ["12:00:00", "12:59:59.999"]


def test_previous_hour_crosses_midnight(make):
    df = make({"event_time": "2025-12-31 23:30:00"}, {"event_time": "2026-01-01 00:10:00"})
    row = only(filters.in_previous_hour(df, as_of="2026-01-01 00:20:00"))
    assert (row["year"], row["month"], row["day"]) == ("2025", "12", "31")


def test_report_counts_outliers_but_not_their_windows(make):
    df = make({}, {"temperature_celsius": 300.0, "device_id": "R-2"}, {"event_time": "2026-03-20 12:07:00"})
    row = only(windows.processing_report(df, as_of="2026-03-20 13:00:00"))
    assert (row["records_processed"], row["aggregates_created"]) == (3, 2)
    nothing = only(windows.processing_report(df, as_of="2026-03-21 13:00:00"))
    assert nothing == {"message": "No data to process", "records_processed": 0, "aggregates_created": 0}


def test_export_line_has_fourteen_fields(make):
    stats = windows.window_stats(make({}, {"battery_level": 51, "speed_mps": None}))
    line = only(windows.format_window_row(stats))["line"].split(",")
    assert len(line) == 14
    assert line[0] == "R-1" and line[2] == str(int(line[1]) + 300_000)
    assert line[3:12] == ["25.00", "25.00", "25.00", "50.50", "50.00", "51.00", "1.00", "1.00", "1.00"]
    assert line[12] == "2"


def test_export_of_a_missing_measure_is_empty(make):
    stats = windows.window_stats(make({"speed_mps": None}))
    assert only(windows.format_window_row(stats))["line"].split(",")[9:12] == ["", "", ""]
