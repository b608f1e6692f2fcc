"""What the optimizer makes of the operators: pushed filters, pruned columns,
hash aggregates, no Python and no unbounded joins."""

import os

import pytest

from telepulse.operators import filters, health, ingest, kpi, quality, reports, windows
from telepulse.plans.catalog import QUERIES
from telepulse.sources import files, tables
from telepulse.sources.events import raw_messages_from_events, telemetry_from_events

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not there")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, make, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "t")
    tables.write_raw(make({}, {"event_time": "2026-03-21 00:00:00"}, {"event_time": "2026-03-22 00:00:00"}), path)
    return files.read_telemetry(spark, path)


@needs_tables
@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin", "SortMergeJoin"):
        assert bad not in text


@pytest.mark.parametrize(
    "operator,days",
    [
        (lambda df: kpi.fleet_kpis(df, as_of="2026-03-21 10:00"), 1),
        (lambda df: quality.quality_checks(df, as_of="2026-03-21 10:00"), 2),
        (lambda df: windows.previous_hour_stats(df, as_of="2026-03-21 01:10"), 1),
        (lambda df: reports.battery_timeline(df, day="2026-03-21"), 1),
        (lambda df: health.fleet_daily_health(df).filter("year = '2026' AND month = '03' AND day = '21'"), 1),
        (lambda df: health.device_status_summary(df).filter("year = '2026' AND month = '03' AND day = '21'"), 1),
        (lambda df: health.zone_activity(df).filter("year = '2026' AND month = '03' AND day = '21'"), 1),
    ],
)
def test_only_the_days_asked_for_are_read(table, operator, days):
    df = operator(table)
    assert "PartitionFilters: [isnotnull(year" in plan(df) or "PartitionFilters: [((" in plan(df)
    df.collect()
    scan = _scan(df._jdf.queryExecution().executedPlan())
    assert scan.metrics().apply("numPartitions").value() == days


def _scan(adaptive):
    """The file scan under an adaptive plan with one input, after it ran."""
    node = adaptive.executedPlan() if adaptive.nodeName() == "AdaptiveSparkPlan" else adaptive
    while True:
        if node.nodeName().startswith("Scan"):
            return node
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        else:
            node = node.children().head()


@needs_tables
def test_event_time_reaches_the_scan_as_ts(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(filters.on_day(telemetry_from_events(events), as_of="2024-01-20 10:00:00"))
    assert "GreaterThanOrEqual(ts,2024-01-20" in text and "LessThanOrEqual(ts,2024" in text


@needs_tables
def test_only_needed_columns_are_read(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(reports.avg_temp_by_device(telemetry_from_events(events)))
    assert "ReadSchema: struct<user_id:bigint,value:double>" in text
    text = plan(reports.record_count(telemetry_from_events(events)))
    assert "ReadSchema: struct<>" in text


def test_rows_are_hash_aggregated(table):
    """No operator sorts raw rows to aggregate them."""
    for operator in (health.fleet_daily_health, health.zone_activity, windows.window_stats, kpi.kpi_history):
        assert "SortAggregate" not in plan(operator(table))
    # Text maxima are sorted, but only after rows were folded per status.
    text = plan(health.device_status_summary(table))
    assert text.count("HashAggregate") >= 2
    assert text.rindex("SortAggregate") < text.index("HashAggregate")


def test_newest_rows_are_chosen_before_the_shuffle(table):
    text = plan(filters.latest_per_device_day(table))
    assert text.count("WindowGroupLimit") == 2


def test_limits_are_top_k(table):
    assert "TakeOrderedAndProject" in plan(reports.last_records(table))
    assert "TakeOrderedAndProject" in plan(reports.device_status_report(table, day="2026-03-21"))


@needs_tables
def test_messages_are_parsed_once(spark):
    """One parse of the envelope and one of the event, whatever is filtered."""
    raw = raw_messages_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet")).select("value")
    for outcome in (ingest.accepted_events, ingest.rejected_events):
        text = plan(outcome(ingest.ingest(raw)))
        assert text.count("from_json") == 2 and "Generate inline" in text


def test_one_scan_for_three_checks(table):
    assert plan(quality.quality_checks(table, as_of="2026-03-21 10:00")).count("FileScan") == 1
