import json

import pytest
from conftest import only
from pyspark.sql import functions as F

from telepulse.functions.calendar import with_partition_columns
from telepulse.operators import ingest, kpi, quality, windows
from telepulse.schema import TELEMETRY_COLUMNS
from telepulse.sources import files, tables
from telepulse.streaming import jobs


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return {name: str(tmp_path / name) for name in ("in", "out", "check", "out2", "check2", "partials")}


def put(make, folder, *changes):
    make(*changes).select(*TELEMETRY_COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def source(spark, make, folder):
    return spark.readStream.schema(make({}).select(*TELEMETRY_COLUMNS).schema).parquet(folder)


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def windows_of(df):
    return sorted((r.device_id, str(r.window_start), r.record_count) for r in df.collect())


def at(time, **changes):
    return {"event_time": f"2026-03-20 {time}", **changes}


def test_final_windows_equal_batch(spark, make, folders):
    rows = [at(f"{h:02d}:{m:02d}:00", device_id=f"R-{m % 3}") for h in range(6) for m in range(0, 60, 7)]
    put(make, folders["in"], *rows, at("06:00:00", temperature_celsius=500.0))
    stream = source(spark, make, folders["in"])
    run(jobs.stream_window_stats(stream, folders["out"], folders["check"], trigger=jobs.ONCE))
    batch = windows.window_stats(make(*rows)).filter("window_end <= TIMESTAMP '2026-03-20 03:56:00'")
    assert windows_of(spark.read.parquet(folders["out"])) == windows_of(batch)
    assert batch.count() > 20


def test_late_rows_within_two_hours_count(spark, make, folders):
    stream = source(spark, make, folders["in"])

    def step(*rows):
        put(make, folders["in"], *rows)
        run(jobs.stream_window_stats(stream, folders["out"], folders["check"], trigger=jobs.ONCE))

    step(at("10:00:00"), at("11:00:00"))
    step(at("10:01:00"), at("12:30:00"))
    # 10:00 is final by now: this row comes too late.
    step(at("10:02:00"), at("15:00:00"))
    found = windows_of(spark.read.parquet(folders["out"]))
    assert found == [
        ("R-1", "2026-03-20 10:00:00", 2),
        ("R-1", "2026-03-20 11:00:00", 1),
        ("R-1", "2026-03-20 12:30:00", 1),
    ]


def test_duplicates_only_go_if_asked(spark, make, folders):
    put(make, folders["in"], at("10:00:00"), at("10:00:00"), at("13:00:00"))
    stream = source(spark, make, folders["in"])
    run(jobs.stream_window_stats(stream, folders["out"], folders["check"], trigger=jobs.ONCE))
    run(jobs.stream_window_stats(stream, folders["out2"], folders["check2"], deduplicate=True, trigger=jobs.ONCE))
    assert [w[2] for w in windows_of(spark.read.parquet(folders["out"]))] == [2]
    assert [w[2] for w in windows_of(spark.read.parquet(folders["out2"]))] == [1]


def test_ingest_splits_and_never_repeats(spark, folders):
    event = {
        "device_id": "R",
        "fleet_id": "F",
        "battery_level": 1,
        "speed_mps": 0,
        "status": "IDLE",
        "location_zone": "Z",
        "temperature_celsius": 1.5,
        "event_time": "2026-03-27T14:30:00Z",
    }
    late = {**event, "event_time": "2025-01-01T00:00:00Z"}
    texts = [json.dumps(e) for e in (event, late, {**event, "battery_level": "1"})] + ["no json"]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    raw.write.mode("append").text(folders["in"])
    stream = spark.readStream.text(folders["in"])
    for _ in range(2):
        run(jobs.stream_ingest(stream, folders["out"], folders["check"], quarantine=folders["out2"], trigger=jobs.ONCE))
    table = files.read_telemetry(spark, folders["out"])
    expected = ingest.accepted_events(ingest.ingest(raw))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, expected.collect()))
    assert {r.year for r in tables.list_partitions(table).collect()} == {"2025", "2026"}
    rejected = spark.read.parquet(folders["out2"])
    assert sorted(r.reject_reason for r in rejected.collect()) == [
        "Failed to parse telemetry data",
        "Missing or invalid field: battery_level",
    ]


def test_metric_jobs_publish_at_each_trigger(spark, make, folders):
    as_of = "2026-03-20 12:00:00"
    stream = source(spark, make, folders["in"])

    def table():
        return with_partition_columns(spark.read.parquet(folders["in"]))

    for expected in (1, 2):
        put(make, folders["in"], at("11:50:00", device_id=f"R-{expected}"))
        options = {"as_of": as_of, "trigger": jobs.ONCE}
        run(jobs.stream_kpis(stream, folders["partials"], folders["out"], folders["check"], **options))
        run(jobs.stream_quality(stream, table, folders["out2"], folders["check2"], **options))
        latest = tables.read_metrics(spark, folders["out"]).filter("metric = 'ActiveDeviceCount'")
        assert latest.agg(F.max("value")).first()[0] == expected
    # the second trigger has the same moment, so its points replace those of the first
    assert tables.read_metrics(spark, folders["out"]).count() == 6
    assert tables.read_metrics(spark, folders["out2"]).count() == 4
    now = {r.metric: r.value for r in kpi.kpi_metrics(kpi.fleet_kpis(table(), as_of=as_of), as_of=as_of).collect()}
    assert now["ActiveDeviceCount"] == 2
    assert only(quality.data_freshness(table(), as_of=as_of))["freshness_minutes"] == 10


EVENT = {"fleet_id": "f", "battery_level": 5, "speed_mps": 0, "status": "ACTIVE", "location_zone": "z", "temperature_celsius": 1}


def put_events(spark, folder, *events):
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").coalesce(1).write.mode("append").text(folder)


def test_a_batch_that_failed_between_both_tables_is_whole_the_second_time(spark, folders, monkeypatch):
    put_events(spark, folders["in"], *[{**EVENT, "device_id": f"d{i}"} for i in range(20)], *[EVENT] * 7)
    stream = spark.readStream.text(folders["in"])

    def start():
        return jobs.stream_ingest(stream, folders["out"], folders["check"], quarantine=folders["out2"], trigger=jobs.ONCE)

    write = jobs.write_batch

    def broken(rows, path, partitions, batch):
        if path == folders["out2"]:
            raise RuntimeError("lost")
        write(rows, path, partitions, batch)

    monkeypatch.setattr(jobs, "write_batch", broken)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination(120)
    first = files.read_telemetry(spark, folders["out"]).collect()
    assert len(first) == 20
    monkeypatch.setattr(jobs, "write_batch", write)
    run(start())
    # times are those of the batch, so its rows are the same as before
    assert sorted(map(tuple, files.read_telemetry(spark, folders["out"]).collect())) == sorted(map(tuple, first))
    assert spark.read.parquet(folders["out2"]).count() == 7
    put_events(spark, folders["in"], {**EVENT, "device_id": "later"})
    run(start())
    assert files.read_telemetry(spark, folders["out"]).count() == 21 and spark.read.parquet(folders["out2"]).count() == 7


def test_files_follow_the_rows_of_a_batch(spark, folders):
    """AQE cuts a day by size: few rows are one file, many are several."""
    for part in range(6):
        put_events(spark, folders["in"], *[{**EVENT, "device_id": f"d{part}-{i}"} for i in range(500)])
    stream = spark.readStream.text(folders["in"])
    run(jobs.stream_ingest(stream, folders["out"], folders["check"], trigger=jobs.ONCE))
    assert len(spark.read.parquet(folders["out"]).inputFiles()) == 1
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "8k")
    try:
        run(jobs.stream_ingest(stream, folders["partials"], folders["check2"], trigger=jobs.ONCE))
    finally:
        spark.conf.unset(size)
    assert len(spark.read.parquet(folders["partials"]).inputFiles()) > 2


def test_a_stream_has_one_name_and_a_batch_one_moment(spark, tmp_path):
    folder = str(tmp_path / "c")
    assert jobs.stream_name(spark, folder) == jobs.stream_name(spark, folder + "/") == jobs.stream_name(spark, f"file:{folder}//")
    assert jobs.stream_name(spark, folder) != jobs.stream_name(spark, folder + "2")
    first = jobs.batch_moment(spark, folder, 3)
    assert jobs.batch_moment(spark, folder + "/", 3) == first != jobs.batch_moment(spark, folder, 4)
    assert jobs.batch_moment(spark, folder, 3, "2026-03-20") == "2026-03-20 00:00:00"


def test_finished_windows_equal_batch(spark, make, folders):
    rows = [at(f"{h:02d}:{m:02d}:00", device_id=f"R-{m % 3}") for h in range(6) for m in range(0, 60, 7)]
    put(make, folders["in"], *rows)
    stream = source(spark, make, folders["in"])
    run(jobs.stream_window_stats(stream, folders["out"], folders["check"], trigger=jobs.ONCE))
    before = windows_of(spark.read.parquet(folders["out"]))
    for _ in range(2):
        jobs.finish_windows(make(*rows), folders["out"])
        assert windows_of(spark.read.parquet(folders["out"])) == windows_of(windows.window_stats(make(*rows)))
    assert len(before) < len(rows)
    # the stream goes on and writes the young windows itself: none is there twice
    more = [at("09:00:00"), at("05:58:00", device_id="R-2")]
    put(make, folders["in"], *more)
    run(jobs.stream_window_stats(stream, folders["out"], folders["check"], trigger=jobs.ONCE))
    jobs.finish_windows(make(*rows, *more), folders["out"])
    assert windows_of(spark.read.parquet(folders["out"])) == windows_of(windows.window_stats(make(*rows, *more)))
    jobs.finish_windows(make(*rows).limit(0), folders["out"])


def test_partials_equal_the_day_at_every_batch(spark, make, tmp_path):
    path = str(tmp_path / "p")
    days = [
        [at("10:00:00"), at("10:01:00", status="ERROR"), at("23:00:00", battery_level=5, device_id="R-2")],
        [at("10:02:00", temperature_celsius=None), {"event_time": "2026-03-19 10:00:00"}],
        [{"event_time": "2026-03-19 11:00:00", "device_id": "R-3"}],
        [at("11:00:00", device_id="R-2", fleet_id="F-2", temperature_celsius=-20.84)],
    ]
    seen = []
    for number, rows in enumerate(days):
        seen += rows
        for _ in range(2):  # a batch that runs again adds nothing
            tables.add_partials(kpi.kpi_partials(make(*rows)), path, number)
        for day in ("2026-03-19", "2026-03-20"):
            as_of = f"{day} 23:59:59.999999"
            found = only(kpi.kpis_of_partials(tables.read_partials(spark, path, as_of), as_of=as_of))
            assert found == only(kpi.fleet_kpis(make(*seen), as_of=as_of)), (number, day)
    # earlier periods only; and what was known after an earlier batch
    early = only(kpi.kpis_of_partials(tables.read_partials(spark, path, "2026-03-20"), as_of="2026-03-20 10:04:59.999999"))
    assert early == only(kpi.fleet_kpis(make(*seen), as_of="2026-03-20 10:04:59.999999"))
    folded = kpi.kpis_of_partials(tables.read_partials(spark, path, "2026-03-20"), as_of="2026-03-20 10:00:00")
    text = folded._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "/p]" in text and "PartitionFilters: [isnotnull(year" in text
    assert only(kpi.kpis_of_partials(tables.read_partials(spark, str(tmp_path / "none"))))["active_device_count"] == 0
