import pytest
from conftest import only

from telepulse.sources.events import telemetry_from_events


@pytest.mark.parametrize(
    "props,level",
    [
        ('{"k": 69}', 69),
        ('{"k":69}', 69),
        ('{"a": {"k": 1}, "k": 7}', 7),
        ('{"k": -3}', -3),
        ('{"k": "12"}', 12),
        ('{"k": null}', None),
        ("{}", None),
        ("no json", None),
        (None, None),
        ('{"k": 99999999999}', None),
    ],
)
def test_battery_level(spark, props, level):
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    events = spark.createDataFrame([(1, None, 12345, "click", 1.0, props)], schema)
    row = only(telemetry_from_events(events))
    assert row["battery_level"] == level
    assert row["device_id"] == "ROBOT-12345"
