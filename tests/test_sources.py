import os

import pytest
from conftest import only
from pyspark.sql import functions as F

from telepulse.operators import health, ingest, windows
from telepulse.schema import TELEMETRY_COLUMNS
from telepulse.sources import files, keyed, tables

HEADER = ",".join(TELEMETRY_COLUMNS)
LINE = "crane-17,harbour,2026-03-20 05:04:03,61,0.25,LIFTING,,quay-3,11.75"


def write(root, day, name, *lines, hour=None, month="03"):
    folder = os.path.join(root, "year=2026", f"month={month}", f"day={day}", *([f"hour={hour}"] if hour else []))
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines) + "\n")
    return os.path.join(folder, name)


def test_csv_with_and_without_header(spark, tmp_path):
    root = str(tmp_path)
    write(root, "20", "a.csv", HEADER, LINE, LINE)
    write(root, "21", "b.csv", LINE.replace("2026-03-20 05:04:03", "2026-03-21T07:37:00Z"))
    df = files.read_telemetry_csv(spark, root)
    rows = df.orderBy("event_time").collect()
    assert len(rows) == 3
    assert (rows[0].year, rows[0].month, rows[0].day) == ("2026", "03", "20")
    assert rows[0].error_code is None and rows[0].battery_level == 61
    assert str(rows[2].event_time) == "2026-03-21 07:37:00"


def test_csv_odd_values(spark, tmp_path):
    write(
        str(tmp_path),
        "20",
        "a.csv",
        "R,F,not a time,8.5,x,ACTIVE,E,Z,NaN",
        "R,F,2026-03-20 07:37:00",
        ",,,,,,,,",
    )
    rows = files.read_telemetry_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 3
    assert rows[0].event_time is None and rows[0].battery_level is None and rows[0].speed_mps is None
    assert rows[1].status is None and rows[2].device_id is None


def test_csv_partition_filter_prunes(spark, tmp_path):
    for day in ("20", "21"):
        write(str(tmp_path), day, "a.csv", HEADER, LINE)
    df = files.read_telemetry_csv(spark, str(tmp_path)).filter("day = '20' AND month = '03'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and df.count() == 1


def test_mixed_depth(spark, tmp_path):
    root = str(tmp_path)
    write(root, "20", "a.csv", HEADER, LINE)
    write(root, "20", "b.csv", LINE, hour="07")
    write(root, "21", "c.csv", LINE, "", hour="08")
    rows = files.read_mixed_telemetry_csv(spark, root).groupBy("month", "day").count().collect()
    assert {(r.month, r.day): r["count"] for r in rows} == {("03", "20"): 2, ("03", "21"): 1}


def test_a_broken_file_of_the_table_fails_the_job(spark, tmp_path, make):
    path = str(tmp_path / "t")
    tables.write_raw(make({}), path)
    folder = os.path.join(path, "year=2026", "month=03", "day=20")
    with open(os.path.join(folder, "broken.parquet"), "w") as out:
        out.write("no parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        files.read_telemetry(spark, path).select("device_id").collect()


def test_missing_table_is_empty(spark, tmp_path):
    df = files.read_telemetry(spark, str(tmp_path / "none"))
    assert df.count() == 0 and health.fleet_daily_health(df).count() == 0
    row = only(windows.processing_report(df, as_of="2026-03-20"))
    assert row["records_processed"] == 0


def test_raw_table_round_trip_and_append(spark, tmp_path, make):
    path = str(tmp_path / "t")
    df = make({}, {"event_time": "2026-03-21 00:00:00"}, {"event_time": "2026-12-01 05:00:00", "error_code": "E"})
    tables.write_raw(df, path)
    tables.write_raw(make({"device_id": "R-9"}), path)
    back = files.read_telemetry(spark, path)
    assert back.count() == 4
    assert sorted(map(tuple, back.filter("device_id <> 'R-9'").select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    assert tables.list_partitions(back).count() == 3


def test_window_rerun_replaces_its_hours_only(spark, tmp_path, make):
    path = str(tmp_path / "w")
    hours = make({}, {"event_time": "2026-03-20 13:00:00"})
    tables.write_window_stats(windows.window_stats(hours), path)
    again = make({"temperature_celsius": 99.0}, {"device_id": "R-2"})
    tables.write_window_stats(windows.previous_hour_stats(again, as_of="2026-03-20 13:10:00"), path)
    tables.write_window_stats(windows.previous_hour_stats(again, as_of="2026-03-20 13:10:00"), path)
    rows = spark.read.parquet(path).orderBy("window_start", "device_id").collect()
    assert [(r.device_id, r.temperature_celsius_max) for r in rows] == [("R-1", 99.0), ("R-2", 25.0), ("R-1", 25.0)]


def metric(spark, value=1.0, fleet="ALL", ts="2026-03-20 10:00:00"):
    return spark.sql(
        f"SELECT 'Telemetry/Fleet' AS namespace, 'A' AS metric, {value}D AS value, 'Count' AS unit, "
        f"map('Fleet', '{fleet}') AS dimensions, TIMESTAMP '{ts}' AS ts"
    )


def test_a_metric_point_is_there_once(spark, tmp_path):
    path = str(tmp_path / "m")
    assert tables.read_metrics(spark, path).count() == 0
    tables.append_metrics(metric(spark), path)
    tables.append_metrics(metric(spark, 2.0), path)
    tables.append_metrics(metric(spark, 3.0, "F-1").union(metric(spark, 4.0, ts="2026-03-21 00:00:00")), path)
    back = tables.read_metrics(spark, path)
    assert sorted(r.value for r in back.collect()) == [2.0, 3.0, 4.0]
    assert back.first().namespace == "Telemetry/Fleet" and back.first().dimensions["Fleet"] in ("ALL", "F-1")
    plan = back.where("date = '2026-03-21'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and back.where("date = '2026-03-21'").count() == 1


def test_a_day_of_metrics_stays_one_file(spark, tmp_path):
    path = str(tmp_path / "m")
    for minute in range(0, 60, 5):
        tables.append_metrics(metric(spark, ts=f"2026-03-20 10:{minute:02d}:00"), path)
    back = tables.read_metrics(spark, path)
    assert back.count() == 12 and len(back.inputFiles()) == 1


def test_a_lost_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    tables.append_metrics(metric(spark), path)

    def lost(*_):
        raise RuntimeError("lost")

    replace = keyed._replace
    monkeypatch.setattr(keyed, "_replace", lost)
    with pytest.raises(RuntimeError):
        tables.append_metrics(metric(spark, 5.0).union(metric(spark, 6.0, "F-1")), path)
    # as if a partition had already been taken away
    keyed.remove_folder(spark, f"{path}/namespace=Telemetry%2FFleet")
    monkeypatch.setattr(keyed, "_replace", replace)
    os.makedirs(f"{path}__merging/half")  # and another merge had not come so far
    tables.append_metrics(metric(spark, 7.0, ts="2026-03-21 10:00:00"), path)
    assert sorted(r.value for r in tables.read_metrics(spark, path).collect()) == [5.0, 6.0, 7.0]
    assert os.listdir(f"{path}__merging") == []


def test_a_device_has_one_row_a_millisecond(spark, tmp_path, make):
    path = str(tmp_path / "t")
    first = make({"event_time": "2026-03-20 12:00:00.0001"}, {"event_time": "2026-03-20 12:00:00.0009", "battery_level": 7}, {"device_id": "R-2"})
    tables.merge_raw(first.withColumn("n", F.monotonically_increasing_id()), path, F.col("n"))
    assert sorted(r.battery_level for r in files.read_telemetry(spark, path).collect()) == [7, 50]
    again = make({"battery_level": 9}, {"event_time": "2026-03-21 12:00:00"}, {"event_time": None})
    for _ in range(2):
        tables.merge_raw(again, path)
        rows = files.read_telemetry(spark, path).collect()
        assert sorted((r.device_id, r.battery_level) for r in rows) == [("R-1", 9), ("R-1", 50), ("R-1", 50), ("R-2", 50)]


def test_skipped_files_are_named(spark, tmp_path):
    root = str(tmp_path)
    write(root, "20", "a.csv", HEADER, LINE)
    with open(write(root, "21", "b.csv.gz", LINE), "wb") as out:
        out.write(b"no archive")
    write(root, "22", "c.csv", LINE, hour="07")
    found = files.file_inventory(spark, root, files.read_lines(spark, root)).collect()
    assert {(os.path.basename(r.path), r.lines, r.skipped) for r in found} == {
        ("a.csv", 2, False), ("b.csv.gz", 0, True), ("c.csv", 1, False)
    }


def test_mixed_depths_prune(spark, tmp_path):
    root = str(tmp_path)
    for day in ("20", "21"):
        write(root, day, "here.csv", HEADER, LINE)
        write(root, day, "b.csv", LINE, hour="07")
    df = files.read_mixed_telemetry_csv(spark, root).filter("day = '20' AND month = '03'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") == 2 and df.count() == 2
    assert files.read_mixed_telemetry_csv(spark, str(tmp_path / "none")).count() == 0


def test_another_session_reads_the_views(spark, table, make):
    name, path = table
    tables.write_raw(make({}, {"device_id": "R-2", "battery_level": 5, "status": "ERROR"}), path)
    tables.repair_partitions(spark, name)
    tables.create_views(spark, name)
    other = spark.newSession()
    try:
        for view in (health.fleet_daily_health, health.device_status_summary, health.zone_activity):
            wanted = view(spark.table(name))
            found = other.table(view.__name__)
            assert found.dtypes == wanted.dtypes and sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
        text = other.sql("SELECT * FROM zone_activity WHERE day = '20'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in text
    finally:
        for view in health.view_sql(name):
            spark.sql(f"DROP VIEW IF EXISTS {view}")


def test_export_has_empty_nulls(spark, tmp_path, make):
    path = str(tmp_path / "csv")
    tables.export_csv(ingest.format_csv_row(make({})).select(*TELEMETRY_COLUMNS), path)
    assert spark.read.text(path).first().value.split(",")[5:8] == ["ACTIVE", "", "Z-1"]


@pytest.fixture
def table(spark, tmp_path):
    name = "telemetry_under_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_telemetry_table(spark, name, str(tmp_path / "t"))
    yield name, str(tmp_path / "t")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_repair_makes_partitions_visible(spark, table, make):
    name, path = table
    tables.write_raw(make({}, {"event_time": "2026-03-21 00:00:00"}), path)
    assert spark.table(name).count() == 0
    tables.repair_partitions(spark, name)
    assert spark.table(name).count() == 2
    assert sorted(r.partition for r in tables.show_partitions(spark, name).collect()) == [
        "year=2026/month=03/day=20",
        "year=2026/month=03/day=21",
    ]


def test_expired_partitions_are_dropped(spark, table, make):
    name, _ = table
    days = ["2025-03-20", "2025-03-21", "2026-03-20"]
    tables.append_to_table(make(*[{"event_time": f"{d} 10:00:00"} for d in days]), name)
    tables.repair_partitions(spark, name)
    as_of = "2026-03-20 15:00:00"
    kept = tables.retention(spark.table(name), as_of=as_of)
    expected = sorted(r.event_time for r in kept.collect())
    assert [str(t)[:10] for t in expected] == ["2025-03-21", "2026-03-20"]
    assert tables.drop_expired_partitions(spark, name, as_of=as_of) == ["year=2025/month=03/day=20"]
    assert sorted(r.event_time for r in spark.table(name).collect()) == expected


def test_the_hourly_job_reads_six_field_files(spark, tmp_path):
    moments = [1774000000000, 1774000060000, 1774000700000]  # 2026-03-20 09:46:40, 09:47:40 and 09:58:20
    lines = [f"pump-{i % 2},{20 + i},50,1000,{ms},x" for i, ms in enumerate(moments)] + ["pump-0,900,50,1000,1774000000000,x"]
    folder = tmp_path / "deep" / "er"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    df = files.read_six_field_csv(spark, str(tmp_path))
    options = {"as_of": "2026-03-20 10:20:00", "measures": windows.SIX_FIELD_MEASURES}
    report = only(windows.processing_report(df, **options))
    assert (report["records_processed"], report["aggregates_created"]) == (4, 3)
    stats = windows.previous_hour_stats(df, **options)
    assert stats.count() == 3 and "humidity_avg" in stats.columns
