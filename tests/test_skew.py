"""One device, fleet, zone and day with most of the rows, against brute force."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from telepulse.operators import filters, health, kpi, windows
from telepulse.sources import files, tables


@pytest.fixture(scope="module")
def rows():
    random.seed(11)
    found = []
    for _ in range(6000):
        hot = random.random() < 0.6
        found.append(
            {
                "device_id": "HOT" if hot else f"R-{random.randrange(40)}",
                "fleet_id": "F-0" if hot else f"F-{random.randrange(3)}",
                "location_zone": "Z-0" if hot else f"Z-{random.randrange(4)}",
                "event_time": str(
                    datetime(2026, 3, 20 if hot else random.choice([19, 20, 21])) + timedelta(seconds=random.randrange(86400))
                ),
                "battery_level": random.choice([None, *range(100)]),
                "speed_mps": random.choice([0.0, 0.5, 2.25]),
                "status": random.choice(["ACTIVE", "IDLE", "ERROR"]),
                "temperature_celsius": round(random.uniform(-60, 160), 1),
            }
        )
    return found


@pytest.fixture(scope="module")
def df(make, rows):
    return make(*rows).repartition(8).cache()


def grouped(rows, *keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row["event_time"][8:10] if k == "day" else row[k] for k in keys)].append(row)
    return groups


def test_fleet_health(df, rows):
    groups = grouped(rows, "day", "fleet_id")
    found = health.fleet_daily_health(df).collect()
    assert len(found) == len(groups)
    for r in found:
        group = groups[(r.day, r.fleet_id)]
        assert r.total_events == len(group)
        assert r.active_devices == len({x["device_id"] for x in group})
        assert r.error_count == sum(x["status"] == "ERROR" for x in group)
        assert r.critical_battery_events == sum(x["battery_level"] is not None and x["battery_level"] < 20 for x in group)
        assert r.stalled_events == sum(x["speed_mps"] == 0 and x["status"] == "ACTIVE" for x in group)
        assert r.high_temp_events == sum(x["temperature_celsius"] > 80 for x in group)


def test_zones(df, rows):
    groups = grouped(rows, "day", "location_zone")
    for r in health.zone_activity(df).collect():
        group = groups.pop((r.day, r.location_zone))
        assert r.total_events == len(group)
        assert r.unique_devices == len({x["device_id"] for x in group})
        assert r.fleet_count == len({x["fleet_id"] for x in group})
        assert r.stopped_events == sum(x["speed_mps"] == 0 for x in group)
    assert not groups


def test_devices_and_latest_rows(df, rows):
    groups = grouped(rows, "day", "fleet_id", "device_id")
    for r in health.device_status_summary(df).collect():
        group = groups.pop((r.day, r.fleet_id, r.device_id))
        newest = max(x["event_time"] for x in group)
        assert r.session_count == len(group) and str(r.last_seen) == newest
        assert r.last_status == max(x["status"] for x in group)
        assert r.latest_status == max(x["status"] for x in group if x["event_time"] == newest)
    assert not groups
    latest = {(r.day, r.device_id): str(r.event_time) for r in filters.latest_per_device_day(df).collect()}
    assert latest == {k: max(x["event_time"] for x in g) for k, g in grouped(rows, "day", "device_id").items()}


def test_windows_keep_every_row(df, rows):
    kept = sum(-50 <= x["temperature_celsius"] <= 150 for x in rows)
    stats = windows.window_stats(df)
    assert stats.agg({"record_count": "sum"}).first()[0] == kept
    assert windows.window_stats(df, length="1 hour").agg({"record_count": "sum"}).first()[0] == kept


def test_kpis(df, rows):
    day = [x for x in rows if x["event_time"].startswith("2026-03-20")]
    row = kpi.fleet_kpis(df, as_of="2026-03-20 23:59:59").first()
    low = {x["device_id"] for x in day if x["battery_level"] is not None and x["battery_level"] < 20}
    assert row.active_device_count == len({x["device_id"] for x in day})
    assert row.error_device_count == len({x["device_id"] for x in day if x["status"] == "ERROR"})
    assert row.critical_battery_count == len(low)
    assert row.fleet_error_rate_pct == round(100 * sum(x["status"] == "ERROR" for x in day) / len(day), 2)


def test_busy_day_is_written_by_several_tasks(spark, df, tmp_path):
    """AQE splits the busy day when it is larger than the advised size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        tables.write_raw(df, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "year=2026" / "month=03" / "day=20").glob("*.parquet"))) > 1
    assert files.read_telemetry(spark, str(tmp_path / "t")).count() == df.count()
