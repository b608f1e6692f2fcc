import json

import pytest
from conftest import only

from telepulse.operators import ingest

EVENT = {
    "device_id": "crane-17",
    "fleet_id": "harbour",
    "battery_level": 61,
    "speed_mps": 0.25,
    "status": "LIFTING",
    "error_code": None,
    "location_zone": "quay-3",
    "temperature_celsius": 11.75,
    "event_time": "2025-11-05T08:07:06Z",
}


def taken(spark, *texts):
    values = [(t if isinstance(t, str) else json.dumps(t),) for t in texts]
    return ingest.ingest(spark.createDataFrame(values, "value string"))


def reason(spark, text):
    return only(taken(spark, text))["reject_reason"]


def without(name):
    return {k: v for k, v in EVENT.items() if k != name}


@pytest.mark.parametrize(
    "wrap",
    [
        lambda e: e,
        lambda e: {"body": json.dumps(e)},
        lambda e: {"Records": [{"Sns": {"Message": json.dumps(e)}}]},
        lambda e: {"body": json.dumps(e), "Records": [{"Sns": {"Message": "no json"}}], "device_id": ""},
    ],
)
def test_envelopes(spark, wrap):
    row = only(ingest.accepted_events(taken(spark, wrap(EVENT))))
    assert row["device_id"] == "crane-17" and row["battery_level"] == 61
    assert (row["year"], row["month"], row["day"]) == ("2025", "11", "05")
    assert row["error_code"] is None


@pytest.mark.parametrize("name", ["device_id", "fleet_id", "status", "location_zone"])
@pytest.mark.parametrize("value", ["absent", "", None])
def test_required_text(spark, name, value):
    event = without(name) if value == "absent" else {**EVENT, name: value}
    assert reason(spark, event) == f"Missing required field: {name}"


@pytest.mark.parametrize("name", ["battery_level", "speed_mps", "temperature_celsius"])
@pytest.mark.parametrize("value", ["absent", "85", "bad", "NaN", "Infinity", None, True, [1], {"a": 1}])
def test_required_number(spark, name, value):
    event = without(name) if value == "absent" else {**EVENT, name: value}
    assert reason(spark, event) == f"Missing or invalid field: {name}"


def test_zero_is_a_number(spark):
    assert reason(spark, {**EVENT, "battery_level": 0, "speed_mps": 0, "temperature_celsius": -0.5}) is None


def test_first_failure_wins(spark):
    assert reason(spark, {"fleet_id": "F"}) == "Missing required field: device_id"
    assert reason(spark, {"device_id": "D", "battery_level": "x"}) == "Missing required field: fleet_id"
    assert reason(spark, {"device_id": "D", "fleet_id": "F"}) == "Missing or invalid field: battery_level"


@pytest.mark.parametrize(
    "text",
    [
        "no json",
        '{"device_id": "A", ',
        '{"body": "no json"}',
        '{"Records": [{"Sns": {"Message": "{"}}]}',
        '{"Records": [{"Sns": {}}]}',
    ],
)
def test_unreadable(spark, text):
    assert reason(spark, text) == ingest.UNREADABLE


def test_values_are_not_judged(spark):
    odd = {**EVENT, "battery_level": 400, "status": "DANCING", "temperature_celsius": 9000}
    assert reason(spark, odd) is None


def test_default_time(spark):
    row = only(ingest.accepted_events(taken(spark, without("event_time")), as_of="2026-04-01 10:00:00"))
    assert str(row["event_time"]) == "2026-04-01 10:00:00" and row["month"] == "04"
    assert only(ingest.accepted_events(taken(spark, {**EVENT, "event_time": ""})))["event_time"] is not None


def test_unreadable_time_is_quarantined(spark):
    assert reason(spark, {**EVENT, "event_time": "yesterday"}) == "Missing or invalid field: event_time"


def test_offset_times_are_utc(spark):
    row = only(ingest.accepted_events(taken(spark, {**EVENT, "event_time": "2026-03-28T01:30:00+02:00"})))
    assert str(row["event_time"]) == "2026-03-27 23:30:00" and row["day"] == "27"


def test_fractional_battery_is_rounded(spark):
    assert only(ingest.accepted_events(taken(spark, {**EVENT, "battery_level": 84.6})))["battery_level"] == 85


def test_nothing_is_lost(spark):
    validated = taken(spark, EVENT, "x", without("status"), {**EVENT, "speed_mps": "1"}, EVENT)
    accepted, rejected = ingest.accepted_events(validated), ingest.rejected_events(validated)
    assert (accepted.count(), rejected.count()) == (2, 3)
    assert ingest.reject_summary(validated).count() == 3
    devices = {r.device_id for r in rejected.collect()}
    assert devices == {"unknown", "crane-17"}


def test_audit_names_the_folder(spark):
    row = only(ingest.ingest_audit(ingest.accepted_events(taken(spark, EVENT))))
    assert row["storage_path"] == "year=2025/month=11/day=05"
    assert row["ingested_at"] is not None


def test_csv_line(spark):
    accepted = ingest.accepted_events(taken(spark, EVENT, {**EVENT, "status": "ERROR", "error_code": "E1"}))
    lines = sorted(r.line for r in ingest.format_csv_row(accepted).collect())
    assert lines == [
        "crane-17,harbour,2025-11-05T08:07:06.000000Z,61,0.25,ERROR,E1,quay-3,11.75",
        "crane-17,harbour,2025-11-05T08:07:06.000000Z,61,0.25,LIFTING,,quay-3,11.75",
    ]


@pytest.mark.parametrize("tail", [" garbage", json.dumps(EVENT), "," + json.dumps(EVENT)])
def test_text_behind_the_object_is_no_json(spark, tail):
    assert reason(spark, json.dumps(EVENT) + tail) == ingest.UNREADABLE
    assert reason(spark, {"body": json.dumps(EVENT) + tail}) == ingest.UNREADABLE


@pytest.mark.parametrize("time", ["12:30", "2026", "2026-03", "T12:30:00Z"])
def test_times_need_a_full_date(spark, time):
    assert reason(spark, {**EVENT, "event_time": time}) == "Missing or invalid field: event_time"
