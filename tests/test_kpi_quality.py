import json

import pytest
from conftest import only
from pyspark.sql import functions as F

from telepulse.operators import kpi, quality

NOON = "2026-03-20 12:00:00"


def metrics_of(df):
    return {r.metric: (r.value, r.unit) for r in df.collect()}


def test_kpis_average_rounded_pairs(make):
    df = make(
        {"battery_level": 10, "event_time": "2026-03-20 01:00:00"},
        {"battery_level": 11, "event_time": "2026-03-20 01:00:00"},
        {"battery_level": 11, "event_time": "2026-03-20 01:00:00"},
        {"fleet_id": "F-2", "battery_level": 90, "status": "ERROR", "event_time": "2026-03-20 01:00:00"},
        {"device_id": "R-2", "battery_level": 20, "event_time": "2026-03-20 01:00:00"},
    )
    row = only(kpi.fleet_kpis(df, as_of=NOON))
    assert row["active_device_count"] == 2
    assert (row["total_error_events"], row["error_device_count"]) == (1, 1)
    # Exactly 20 is not critical.
    assert row["critical_battery_count"] == 1
    # 10.7, 90.0 and 20.0, each once.
    assert row["fleet_avg_battery"] == 40.2
    assert row["fleet_error_rate_pct"] == 20.0


def test_only_the_day_up_to_the_moment(make):
    df = make(
        {"event_time": "2026-03-19 23:59:59"},
        {"event_time": "2026-03-20 00:00:00", "device_id": "R-2"},
        {"event_time": NOON, "device_id": "R-3"},
        {"event_time": "2026-03-20 12:00:01", "device_id": "R-4"},
    )
    assert only(kpi.fleet_kpis(df, as_of=NOON))["active_device_count"] == 2


def test_no_data_publishes_zeros(make):
    kpis = kpi.fleet_kpis(make({}), as_of="2026-04-01")
    found = metrics_of(kpi.kpi_metrics(kpis, as_of="2026-04-01"))
    assert len(found) == 6 and {value for value, _ in found.values()} == {0.0}
    assert found["AvgTemperatureCelsius"][1] == "None" and found["FleetErrorRatePct"][1] == "Percent"


def test_fleets_and_all(make):
    df = make({}, {"fleet_id": "F-2"}, {"fleet_id": "F-2", "device_id": "R-2"})
    rows = {r.fleet: r.active_device_count for r in kpi.fleet_kpis_by_fleet(df, as_of="2026-03-20 23:00").collect()}
    assert rows == {"F-1": 1, "F-2": 2, "ALL": 2}
    metrics = kpi.kpi_metrics(kpi.fleet_kpis_by_fleet(df, as_of=NOON), as_of=NOON).collect()
    assert {r.dimensions["Fleet"] for r in metrics} == {"F-1", "F-2", "ALL"}


def test_history_matches_the_daily_job(make):
    df = make({}, {"event_time": "2026-03-21 01:00:00", "status": "ERROR"}, {"device_id": "R-2"})
    history = {str(r.period_start)[:10]: r for r in kpi.kpi_history(df).collect()}
    for day in ("2026-03-20", "2026-03-21"):
        now = only(kpi.fleet_kpis(df, as_of=f"{day} 23:59:59"))
        assert {k: history[day][k] for k in now} == now


@pytest.mark.parametrize("minutes,alerts", [(0, 0), (30, 0), (31, 1)])
def test_freshness(make, minutes, alerts):
    df = make({"event_time": "2026-03-20 11:00:30"}, {"event_time": "2026-03-20 10:00:00"})
    checks = quality.quality_checks(df, as_of=f"2026-03-20 11:{minutes:02d}:59")
    row = only(checks)
    assert row["freshness_minutes"] == minutes and row["last_seen"] == "2026-03-20 11:00:30"
    assert quality.quality_alerts(checks).count() == alerts
    assert only(quality.data_freshness(df, as_of=f"2026-03-20 11:{minutes:02d}:59"))["freshness_minutes"] == minutes


def test_no_data_today(make):
    checks = quality.quality_checks(make({"event_time": "2026-03-19 10:00:00"}), as_of=NOON)
    row = only(checks)
    assert (row["freshness_minutes"], row["last_seen"], row["partition_exists"]) == (9999, "NEVER", False)
    assert (row["today_count"], row["yesterday_count"], row["delta_percent"]) == (0, 1, -100)
    assert [r.check for r in quality.quality_alerts(checks).collect()] == ["freshness", "partition", "device_count"]
    alert = only(quality.consolidated_alert(checks))
    assert alert["subject"].endswith("(3 check(s) failed)") and alert["message"].count("\n\n---\n\n") == 2
    report = json.loads(only(quality.quality_report(checks))["report"])
    assert report["checksRun"] == 3 and report["alertsFired"] == 3
    assert report["deviceCount"] == {"todayCount": 0, "yesterdayCount": 1, "deltaPercent": -100}
    found = metrics_of(quality.quality_metrics(checks, as_of=NOON))
    assert found["DataFreshnessMinutes"][0] == 9999.0 and found["TodayPartitionExists"][0] == 0.0


def test_nothing_wrong_sends_nothing(make):
    df = make({"event_time": "2026-03-20 11:50:00"}, {"event_time": "2026-03-19 11:00:00"})
    checks = quality.quality_checks(df, as_of=NOON)
    assert quality.consolidated_alert(checks).count() == 0
    assert quality.quality_alerts(checks).count() == 0


@pytest.mark.parametrize(
    "today,yesterday,delta,alert",
    [(7, 10, -30, False), (69, 100, -31, True), (139, 200, -30, False), (5, 0, 0, False), (3, 2, 50, False)],
)
def test_regression(spark, make, today, yesterday, delta, alert):
    days = [("2026-03-20 11:59:00", today), ("2026-03-19 05:00:00", yesterday)]
    rows = [{"device_id": f"R-{i}", "event_time": time} for time, n in days for i in range(n)]
    checks = quality.quality_checks(make(*rows, *rows), as_of=NOON)
    row = only(checks)
    assert (row["today_count"], row["yesterday_count"], row["delta_percent"]) == (today, yesterday, delta)
    fired = {r.check for r in quality.quality_alerts(checks).collect()}
    assert ("device_count" in fired) == alert
    literal = only(quality.device_count_regression(make(*rows), as_of=NOON))
    assert literal["delta_percent"] == delta


def test_freshness_history_equals_the_check(make):
    times = ["00:10:00", "03:59:59", "04:00:00", "09:30:00"]
    df = make(*[{"event_time": f"2026-03-20 {t}"} for t in times])
    history = {r.period_start.hour: r.freshness_minutes for r in quality.freshness_history(df, period_seconds=3600).collect()}
    assert len(history) == 24
    for hour in range(23):
        check = only(quality.data_freshness(df, as_of=f"2026-03-20 {hour + 1:02d}:00:00"))
        # A row at the very end of a period belongs to the next one in both.
        assert history[hour] == check["freshness_minutes"]


def test_a_day_without_telemetry_raises_the_freshness_alarm(make):
    from telepulse.operators import alarms
    from telepulse.plans.catalog import HOURLY_RULES, QUALITY_NAMESPACE

    df = make({"event_time": "2026-03-20 23:50:00"}, {"event_time": "2026-03-22 12:00:00"})
    history = quality.freshness_history(df, period_seconds=3600)
    outage = [r.freshness_minutes for r in history.filter("to_date(period_start) = '2026-03-21'").collect()]
    assert outage == [9999] * 24
    points = history.select(
        F.lit(QUALITY_NAMESPACE).alias("namespace"),
        F.lit("DataFreshnessMinutes").alias("metric"),
        F.col("freshness_minutes").cast("double").alias("value"),
        F.lit("None").alias("unit"),
        F.create_map(F.lit("Pipeline"), F.lit("Telemetry")).alias("dimensions"),
        F.col("period_start").alias("ts"),
    )
    states = alarms.evaluate_alarms(points, [HOURLY_RULES["data-freshness"]])
    assert {r.state for r in states.filter("to_date(period_start) = '2026-03-21' AND hour(period_start) > 3").collect()} == {"ALARM"}


def test_kpi_history_is_the_day_so_far(make):
    df = make(
        {"device_id": "A", "event_time": "2026-03-20 01:10:00", "battery_level": 10},
        {"device_id": "B", "event_time": "2026-03-20 02:10:00", "status": "ERROR"},
        {"device_id": "A", "event_time": "2026-03-22 03:00:00"},
    )
    rows = {str(r.period_start): r for r in kpi.kpi_history(df, period="1 hour").collect()}
    assert len(rows) == 72
    counts = [rows[f"2026-03-20 0{h}:00:00"].active_device_count for h in range(4)]
    assert counts == [0, 1, 2, 2]
    for end in ("01", "02", "07"):
        live = kpi.fleet_kpis(df, as_of=f"2026-03-20 {end}:59:59").first().asDict()
        then = rows[f"2026-03-20 {end}:00:00"].asDict()
        assert {k: then[k] for k in live} == live
    assert {r.active_device_count for k, r in rows.items() if k.startswith("2026-03-21")} == {0}


def test_low_battery_limit_is_a_parameter(make):
    df = make({"battery_level": 25})
    assert kpi.fleet_kpis(df, as_of="2026-03-20 23:00:00").first().critical_battery_count == 0
    assert kpi.fleet_kpis(df, as_of="2026-03-20 23:00:00", low_battery=30).first().critical_battery_count == 1


def test_rows_of_the_partition_without_a_time_are_counted(make):
    df = make({}, {"device_id": "R-2"})
    df = df.withColumn("event_time", F.when(F.col("device_id") == "R-1", F.col("event_time")))
    assert kpi.fleet_kpis(df, as_of="2026-03-20 23:00:00").first().active_device_count == 2


@pytest.mark.parametrize(("value", "digits", "wanted"), [(2.3449996, 2, 2.34), (1.005, 2, 1.01), (-30.5, 0, -31.0), (1234567890123.455, 2, 1234567890123.46)])
def test_rounding_on_decimal_digits(spark, value, digits, wanted):
    from telepulse.functions.numeric import round_half_up

    assert spark.range(1).select(round_half_up(F.lit(value), digits)).first()[0] == wanted
