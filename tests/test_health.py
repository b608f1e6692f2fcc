from conftest import only

from telepulse.operators import filters, health, reports


def test_fleet_counts_conditions(make):
    df = make(
        {"status": "ERROR", "battery_level": 20, "temperature_celsius": 80.0},
        {"status": "ACTIVE", "speed_mps": 0.0, "battery_level": 19, "temperature_celsius": 80.1},
        {"status": "IDLE", "speed_mps": 0.0, "device_id": "R-2"},
    )
    row = only(health.fleet_daily_health(df))
    assert (row["total_events"], row["active_devices"], row["error_count"]) == (3, 2, 1)
    assert row["error_rate_pct"] == 33.33
    assert (row["critical_battery_events"], row["min_battery_pct"]) == (1, 19)
    assert (row["stalled_events"], row["high_temp_events"], row["max_temp_celsius"]) == (1, 1, 80.1)


def test_missing_readings_do_not_count(make):
    df = make({"battery_level": None, "temperature_celsius": float("nan"), "speed_mps": None})
    row = only(health.fleet_daily_health(df))
    assert row["avg_battery_pct"] is None and row["avg_speed_mps"] is None
    assert row["high_temp_events"] == 0 and row["critical_battery_events"] == 0
    device = only(health.device_status_summary(df))
    assert device["avg_battery_pct"] is None and device["session_count"] == 1


def test_device_in_two_fleets_is_two_rows(make):
    df = make({}, {"fleet_id": "F-2"}, {"fleet_id": "F-2"})
    rows = {r.fleet_id: r.session_count for r in health.device_status_summary(df).collect()}
    assert rows == {"F-1": 1, "F-2": 2}


def test_last_and_latest_status(make):
    df = make(
        {"status": "MOVING", "event_time": "2026-03-20 08:00:00"},
        {"status": "CHARGING", "event_time": "2026-03-20T09:00:00Z"},
        {"status": "MOVING", "event_time": "2026-03-20 07:00:00"},
    )
    row = only(health.device_status_summary(df))
    assert row["last_status"] == "MOVING" and row["latest_status"] == "CHARGING"
    assert str(row["last_seen"]) == "2026-03-20 09:00:00"


def test_zone_distincts(make):
    df = make({}, {"fleet_id": "F-2"}, {"device_id": "R-2"}, {"device_id": "R-2", "speed_mps": 0.0}, {"device_id": None})
    row = only(health.zone_activity(df))
    assert (row["total_events"], row["unique_devices"], row["fleet_count"]) == (5, 2, 2)
    assert row["stopped_events"] == 1


def test_days_are_apart(make):
    df = make({"event_time": "2026-03-20 23:59:59.999"}, {"event_time": "2026-03-21 00:00:00"})
    assert health.fleet_daily_health(df).count() == 2


def test_ties_round_half_away_from_zero(make):
    df = make({"speed_mps": 1.005}, {"speed_mps": 1.005})
    assert only(health.fleet_daily_health(df))["avg_speed_mps"] == 1.01
    df = make({"temperature_celsius": -0.25})
    assert only(health.fleet_daily_health(df))["avg_temp_celsius"] == -0.3


def test_huge_values_survive_rounding(make):
    df = make({"temperature_celsius": 1e20})
    assert only(health.fleet_daily_health(df))["avg_temp_celsius"] == 1e20


def test_latest_per_device_day_is_deterministic(make):
    same = "2026-03-20 10:00:00"
    df = make({"event_time": same, "fleet_id": "F-2"}, {"event_time": same, "fleet_id": "F-1"}, {"event_time": "2026-03-20 09:00:00"})
    for partitions in (1, 4):
        assert only(filters.latest_per_device_day(df.repartition(partitions)))["fleet_id"] == "F-1"


def test_reports_limit_and_order(make):
    df = make(*[{"device_id": f"R-{i:03d}", "event_time": f"2026-03-20 10:00:{i:02d}"} for i in range(30)])
    newest = reports.device_status_report(df, day="2026-03-20").collect()
    assert len(newest) == 20 and newest[0].device_id == "R-029" and newest[-1].device_id == "R-010"
    assert reports.telemetry_sample(df, year=2026, month=3).count() == 10
    assert reports.telemetry_sample(df, year=2026, month=4).count() == 0
    assert reports.named_query(df, "temperature_statistics", year=2026, month=3).count() == 30


def test_december_month(make):
    df = make({"event_time": "2025-12-31 23:00:00"}, {"event_time": "2026-01-01 00:00:00"})
    assert filters.in_month(df, year=2025, month=12).count() == 1


def test_wider_report_decimals(make):
    df = make({"temperature_celsius": 1234.5})
    row = only(reports.temperature_statistics(df, year=2026, month=3, precision=8))
    assert float(row["max_temp"]) == 1234.5
