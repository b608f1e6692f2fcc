from conftest import only

from telepulse.operators import health, quality


def test_thresholds_can_be_given(make):
    df = make({"battery_level": 30, "temperature_celsius": 60.0})
    row = only(health.fleet_daily_health(df, low_battery=31, high_temperature=59))
    assert (row["critical_battery_events"], row["high_temp_events"]) == (1, 1)
    assert only(health.zone_activity(df, low_battery=31))["low_battery_count"] == 1
    checks = quality.quality_checks(df, as_of="2026-03-20 12:10:00")
    assert quality.quality_alerts(checks).count() == 0
    assert quality.quality_alerts(checks, stale_after=9).count() == 1
