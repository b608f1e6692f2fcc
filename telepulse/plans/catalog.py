"""Named queries over a folder of tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Averages that a
report leaves unrounded are rounded here, since the last digits of a sum of
doubles depend on the order of the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telepulse.functions import numeric
from telepulse.functions.calendar import display_time, moment_literal, with_partition_columns
from telepulse.operators import alarms, filters, health, ingest, kpi, notify, quality, reports, windows
from telepulse.schema import PARTITION_COLUMNS, QUALITY_NAMESPACE, RESULT_RETENTION_DAYS, TELEMETRY_COLUMNS
from telepulse.session import pin_utc, shared_folder
from telepulse.sources import events as adapters
from telepulse.sources import files, tables
from telepulse.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Moments the as-of queries ask for; the tables span January 2024.
KPI_AS_OF = "2024-01-29 23:59:59"
KPI_DAY_END = "2024-01-29 23:59:59.999999"
QUALITY_AS_OF = "2024-01-30 06:00:00"
HOUR_AS_OF = "2024-01-20 15:20:00"
NO_DATA_AS_OF = "2024-02-05 00:00:00"
INGEST_AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2025-01-14 00:00:00"
REPORT_DAY = "2024-01-20"
YEAR, MONTH = 2024, 1

# Events are sparse, so alarms are evaluated per hour; freshness against 10 minutes.
HOURLY_RULES = {
    name: replace(rule, period_seconds=3600, threshold=10.0 if name == "data-freshness" else rule.threshold)
    for name, rule in alarms.RULES.items()
}

QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _on_telemetry(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(telemetry(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.telemetry_from_events(events(spark, sf_dir))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: numeric.round_half_up(F.col(name), digits) for name in names})


def _window_rows(stats: DataFrame) -> DataFrame:
    averages = [f"{name}_avg" for name in windows.TELEMETRY_MEASURES]
    return _rounded(stats.drop("processed_at"), 2, *averages)


def _without_time_zone(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _as_text(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("dimensions", F.to_json("dimensions"))


def _run_folder(spark: SparkSession, name: str) -> tuple[str, str]:
    root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    return f"{root}/table", f"{root}/checkpoint"


# --- sources, sinks, catalog ---------------------------------------------------
DAY = PARTITION_COLUMNS


def _write_lines(lines: DataFrame, folder: str, *keys: str) -> None:
    """Write column ``value`` as compressed text under folders of the keys, a file each."""
    files_of = lines.select("value", *keys).repartition(*keys).write.mode("append").partitionBy(*keys)
    files_of.option("compression", "gzip").text(folder)


def _telemetry_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """CSV lines with their day, and a header line for each day's file."""
    lines = ingest.format_csv_row(adapters.telemetry_from_events(events(spark, sf_dir), keep=("event_id",)))
    return lines.withColumnRenamed("line", "value").select("value", *DAY, *keep)


def _header(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.select(F.lit(",".join(TELEMETRY_COLUMNS)).alias("value"), *keys).distinct()


@_register
def read_telemetry_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it reads back from CSV files with header lines."""
    folder, _ = _run_folder(spark, "read_telemetry_csv")
    lines = _telemetry_lines(spark, sf_dir)
    _write_lines(lines.union(_header(lines, *DAY)), folder, *DAY)
    return _without_time_zone(files.read_telemetry_csv(spark, folder), "event_time")


@_register
def read_mixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every second event lies in a folder of its hour."""
    folder, _ = _run_folder(spark, "read_mixed_csv")
    lines = _telemetry_lines(spark, sf_dir, "event_id", "event_time").withColumn("hour", F.date_format("event_time", "HH"))
    _write_lines(lines.where("event_id % 2 = 0"), folder, *DAY)
    deep = lines.where("event_id % 2 = 1")
    deep = deep.select("value", *DAY, "hour").union(_header(deep, *DAY, "hour"))
    _write_lines(deep, folder, *DAY, "hour")
    return _without_time_zone(files.read_mixed_telemetry_csv(spark, folder), "event_time")


@_register
def tolerant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and lines per day: the first and the last day's file is broken, and every thirteenth line ends early."""
    folder, _ = _run_folder(spark, "tolerant_read")
    lines = _telemetry_lines(spark, sf_dir, "event_id")
    cut = F.when(F.col("event_id") % 13 == 0, F.substring_index("value", ",", 4)).otherwise(F.col("value"))
    _write_lines(lines.withColumn("value", cut), folder, *DAY)
    span = lines.agg(F.min(F.struct(*DAY)).alias("first"), F.max(F.struct(*DAY)).alias("last")).first()
    for day in {tuple(span["first"]), tuple(span["last"])}:
        place = "/".join(f"{name}={value}" for name, value in zip(DAY, day, strict=True))
        for name in files.folders(spark, f"{folder}/{place}"):
            files.write_bytes(spark, name, b"no archive")
    read = files.read_lines(spark, folder)
    bad = files.skipped_lines(read).groupBy("path").agg(F.count("*").alias("skipped"))
    found = files.file_inventory(spark, folder, read).withColumnRenamed("skipped", "gone").join(bad, "path", "left")
    parts = [F.regexp_extract("path", rf"/{name}=([^/]+)", 1) for name in DAY]
    return found.groupBy(F.concat_ws("/", *parts).alias("path")).agg(
        F.sum("lines").alias("lines"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"),
        F.count("*").alias("files"),
        F.count_if("gone").alias("skipped_files"),
    )


@_register
def six_field_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly window job over files of the older six-field record."""
    folder, _ = _run_folder(spark, "six_field_windows")
    lines = _six_field_lines(spark, sf_dir).withColumn("part", F.col("event_id") % 3)
    _write_lines(lines, folder, "part")
    rows = files.read_six_field_csv(spark, folder)
    stats = windows.previous_hour_stats(rows, as_of=HOUR_AS_OF, measures=windows.SIX_FIELD_MEASURES)
    shown = _rounded(stats.drop("processed_at"), 2, *[f"{name}_avg" for name in windows.SIX_FIELD_MEASURES])
    return _without_time_zone(shown, "window_start", "window_end")


@_register
def repair_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of a catalog table whose folders were written beside the catalog and then registered."""
    table, _ = _run_folder(spark, "repair_partitions")
    spark.sql("DROP TABLE IF EXISTS repaired_telemetry")
    tables.create_telemetry_table(spark, "repaired_telemetry", table)
    tables.write_raw(telemetry(spark, sf_dir), table)
    tables.repair_partitions(spark, "repaired_telemetry")
    return spark.table("repaired_telemetry").groupBy("year", "month", "day").agg(F.count("*").alias("events"))


_on_telemetry("read_hour", lambda df: filters.in_previous_hour(df, as_of=HOUR_AS_OF))


def _six_field_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-field lines made of events; every ninth lacks a number, some end early."""
    number = F.col("event_id")
    fields = [
        F.concat(F.lit("ROBOT-"), F.col("user_id").cast("string")),
        F.when(number % 9 == 0, "n/a").otherwise(F.col("value").cast("string")),
        F.when(number % 9 == 1, "").otherwise((number % 100).cast("string")),
        (number % 50 + F.lit(0.25)).cast("string"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
    ]
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.when(number % 9 == 2, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, iso))
    return events(spark, sf_dir).select(line.alias("value"), "event_id")


@_register
def parse_csv_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parse_six_field_lines(_six_field_lines(spark, sf_dir))


_on_telemetry("empty_input", lambda df: windows.processing_report(df, as_of=NO_DATA_AS_OF))
_on_telemetry("processing_report", lambda df: windows.processing_report(df, as_of=HOUR_AS_OF))
_on_telemetry("format_csv_row", lambda df: ingest.format_csv_row(df).select("line"))
_on_telemetry(
    "format_aggregate_row",
    lambda df: windows.format_window_row(
        windows.window_stats(df).withColumn("processed_at", moment_literal(KPI_AS_OF))
    ),
)
_on_telemetry("show_partitions", tables.list_partitions)
_on_telemetry("retention", lambda df: tables.retention(df, as_of=RETENTION_AS_OF))
_on_telemetry(
    "result_retention", lambda df: tables.retention(df, as_of="2024-02-09", days=RESULT_RETENTION_DAYS)
)
_on_telemetry("bi_fleet_daily_health", health.bi_fleet_daily_health)
_on_telemetry("bi_device_status_summary", health.bi_device_status_summary)


@_register
def write_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry table as it reads back after it was written."""
    table, _ = _run_folder(spark, "write_raw")
    tables.write_raw(telemetry(spark, sf_dir), table)
    return _without_time_zone(files.read_telemetry(spark, table), "event_time")


@_register
def write_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows written twice: the second run replaces the first."""
    table, _ = _run_folder(spark, "write_window_stats")
    for _ in range(2):
        tables.write_window_stats(windows.window_stats_daily(telemetry(spark, sf_dir)), table)
    return _window_rows(spark.read.parquet(table).drop("year", "month", "day", "hour"))


@_register
def merge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with a row a device and millisecond: the first has every event twice, the second a third of them again."""
    table, _ = _run_folder(spark, "merge_raw")
    rows = adapters.telemetry_from_events(events(spark, sf_dir), keep=("event_id",))
    first = rows.withColumn("version", F.lit(2)).union(rows.withColumn("version", F.lit(1)))
    first = first.withColumn("status", F.when(F.col("version") == 2, F.col("status")).otherwise("STALE"))
    tables.merge_raw(first, table, F.col("version"))
    for _ in range(2):  # a batch that is written again changes nothing
        tables.merge_raw(rows.where("event_id % 3 = 0").withColumn("status", F.lit("FINAL")), table)
    return _without_time_zone(files.read_telemetry(spark, table), "event_time")


@_register
def append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly KPI metrics, published twice, as the metrics table gives them back."""
    table, _ = _run_folder(spark, "append_metrics")
    for _ in range(2):
        tables.append_metrics(_kpi_points(spark, sf_dir), table)
    return _as_text(_without_time_zone(tables.read_metrics(spark, table).drop("date"), "ts"))


@_register
def create_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the catalog, asked by another session: devices in trouble on the days their fleet was."""
    table, _ = _run_folder(spark, "create_views")
    spark.sql("DROP TABLE IF EXISTS viewed_telemetry")
    tables.create_telemetry_table(spark, "viewed_telemetry", table)
    tables.write_raw(telemetry(spark, sf_dir), table)
    tables.repair_partitions(spark, "viewed_telemetry")
    tables.create_views(spark, "viewed_telemetry")
    return pin_utc(spark.newSession()).sql(
        "SELECT year, month, day, fleet_id, device_id, error_rate_pct, min_battery_pct "
        "FROM device_status_summary WHERE error_rate_pct > 50 AND min_battery_pct < 20"
    )


# --- ingest ----------------------------------------------------------------------
def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest(adapters.raw_messages_from_events(events(spark, sf_dir)))


@_register
def unwrap_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.raw_messages_from_events(events(spark, sf_dir))
    return ingest.unwrap_event(raw).select("event_id", "event.*")


@_register
def validate_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("event_id", "reject_reason")


@_register
def accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.accepted_events(_validated(spark, sf_dir), as_of=INGEST_AS_OF, keep=("event_id",))
    return _without_time_zone(rows, "event_time")


@_register
def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejected_events(_validated(spark, sf_dir), keep=("event_id",)).drop("payload")


@_register
def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.reject_summary(_validated(spark, sf_dir))


@_register
def default_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events got the default time, per day they land in."""
    rows = ingest.accepted_events(_validated(spark, sf_dir), as_of=INGEST_AS_OF)
    is_default = F.col("event_time") == moment_literal(INGEST_AS_OF)
    return rows.groupBy("year", "month", "day").agg(
        F.count("*").alias("events"), F.count_if(is_default).alias("default_times")
    )


@_register
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_partition_columns(events(spark, sf_dir).select("event_id", "ts"), "ts", hour=True)


@_register
def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.accepted_events(_validated(spark, sf_dir), as_of=INGEST_AS_OF)
    return _without_time_zone(ingest.ingest_audit(rows).drop("ingested_at"), "event_time")


# --- filters ---------------------------------------------------------------------
_on_telemetry("filter_partition_day", lambda df: filters.on_day(df, as_of=QUALITY_AS_OF))
_on_telemetry("filter_two_days", lambda df: filters.on_two_days(df, as_of=QUALITY_AS_OF))
_on_telemetry("filter_outliers", filters.drop_outliers)
_on_telemetry("filter_status_error", filters.has_status)
_on_telemetry("conditional_counts", reports.conditional_counts)
_on_telemetry("latest_per_device_day", filters.latest_per_device_day)

# --- views, windows, KPIs ----------------------------------------------------------
_on_telemetry("fleet_daily_health", health.fleet_daily_health)
_on_telemetry("device_status_summary", health.device_status_summary)
_on_telemetry("zone_activity", health.zone_activity)
_on_telemetry("window_stats", lambda df: _window_rows(windows.window_stats(df)))
_on_telemetry("window_stats_daily", lambda df: _window_rows(windows.window_stats_daily(df)))
_on_telemetry(
    "window_stats_previous_hour",
    lambda df: _window_rows(windows.previous_hour_stats(df, as_of=HOUR_AS_OF)),
)
_on_telemetry("fleet_kpis", lambda df: kpi.fleet_kpis(df, as_of=KPI_AS_OF))
_on_telemetry("fleet_kpis_by_fleet", lambda df: kpi.fleet_kpis_by_fleet(df, as_of=KPI_AS_OF))
_on_telemetry("kpi_history", kpi.kpi_history)
_on_telemetry(
    "kpi_metrics",
    lambda df: _as_text(kpi.kpi_metrics(kpi.fleet_kpis(df, as_of=KPI_AS_OF), as_of=KPI_AS_OF)),
)
_on_telemetry(
    "kpis_no_data",
    lambda df: _as_text(kpi.kpi_metrics(kpi.fleet_kpis(df, as_of=NO_DATA_AS_OF), as_of=NO_DATA_AS_OF)),
)
_on_telemetry(
    "kpi_metrics_by_fleet",
    lambda df: _as_text(kpi.kpi_metrics(kpi.fleet_kpis_by_fleet(df, as_of=KPI_AS_OF), as_of=KPI_AS_OF)),
)

# --- data quality ------------------------------------------------------------------
_on_telemetry("data_freshness", lambda df: quality.data_freshness(df, as_of=QUALITY_AS_OF))
_on_telemetry("data_freshness_no_data", lambda df: quality.data_freshness(df, as_of=NO_DATA_AS_OF))
_on_telemetry("partition_health", lambda df: quality.partition_health(df, as_of=QUALITY_AS_OF))
_on_telemetry("device_count_regression", lambda df: quality.device_count_regression(df, as_of=QUALITY_AS_OF))
_on_telemetry("quality_checks", lambda df: quality.quality_checks(df, as_of=QUALITY_AS_OF))
_on_telemetry("freshness_history", lambda df: quality.freshness_history(df, period_seconds=3600))


def _checks(df: DataFrame, as_of: str = QUALITY_AS_OF) -> DataFrame:
    return quality.quality_checks(df, as_of=as_of)


_on_telemetry(
    "quality_metrics", lambda df: _as_text(quality.quality_metrics(_checks(df), as_of=QUALITY_AS_OF))
)
_on_telemetry("quality_alerts", lambda df: quality.quality_alerts(_checks(df)))
_on_telemetry("quality_alerts_no_data", lambda df: quality.quality_alerts(_checks(df, NO_DATA_AS_OF)))
_on_telemetry("consolidated_alert", lambda df: quality.consolidated_alert(_checks(df, NO_DATA_AS_OF)))
_on_telemetry("quality_report", lambda df: quality.quality_report(_checks(df)))

# --- reports -------------------------------------------------------------------------
_on_telemetry("temperature_statistics", lambda df: reports.temperature_statistics(df, year=YEAR, month=MONTH))
_on_telemetry(
    "speed_and_battery_analysis", lambda df: reports.speed_and_battery_analysis(df, year=YEAR, month=MONTH)
)
_on_telemetry("avg_temp_by_device", lambda df: _rounded(reports.avg_temp_by_device(df), 4, "avg_temp"))
_on_telemetry(
    "device_avg_month", lambda df: _rounded(reports.device_avg_month(df, year=YEAR, month=MONTH), 4, "avg_temp")
)
_on_telemetry("record_count", reports.record_count)
_on_telemetry(
    "telemetry_sample", lambda df: reports.named_query(df, "device_telemetry_sample", year=YEAR, month=MONTH)
)
_on_telemetry("last_records", reports.last_records)
_on_telemetry("device_status_report", lambda df: reports.device_status_report(df, day=REPORT_DAY))
_on_telemetry("battery_timeline", lambda df: reports.battery_timeline(df, day=REPORT_DAY))
_on_telemetry("error_events", lambda df: reports.error_events(df, year=YEAR, month=MONTH))

AD_HOC_SQL = (
    "SELECT device_id, status, COUNT(*) AS events, MIN(battery_level) AS min_battery, "
    "MAX(error_code) AS error_code FROM device_telemetry "
    "WHERE year = '2024' AND month = '01' AND day = '20' GROUP BY device_id, status "
    "ORDER BY device_id, status"
)


@_register
def run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    telemetry(spark, sf_dir).createOrReplaceTempView("device_telemetry")
    return reports.run_sql(spark, f"  {AD_HOC_SQL}\n")


@_register
def scalar_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar expressions of the inventory, over every event."""
    number, value = F.col("event_id"), F.col("value")
    text_time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return events(spark, sf_dir).select(
        "event_id",
        numeric.round_half_up(value / 3, 2).alias("rounded"),
        numeric.percentage(number % 7, number % 4).alias("safe_percentage"),
        numeric.round_half_to_plus_infinity(number % 9 - F.lit(4.5)).alias("half_up"),
        F.least(F.floor(value * 40), F.lit(9999)).alias("capped"),
        F.abs(number % 5 - 2).alias("absolute"),
        (number % 2 == 0).cast("int").alias("flag"),
        F.coalesce(F.nullif(F.get_json_object("props", "$.missing"), F.lit("")), F.lit("0"))
        .try_cast("double")
        .alias("defaulted"),
        F.coalesce(F.col("event_type").try_cast("double"), F.lit(-1.0)).alias("no_number"),
        F.substring(F.trim(F.concat(F.lit("  "), F.repeat("event_type", 30), F.lit(" "))), 1, 100).alias("head"),
        F.concat_ws("-", F.date_format("ts", "yyyy"), F.date_format("ts", "MM")).alias("year_month"),
        (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
        F.window("ts", "5 minutes")["start"].alias("window_start"),
        display_time(text_time).alias("shown"),
        display_time(F.col("event_type")).alias("shown_invalid"),
    )


# --- metrics and alarms -----------------------------------------------------------------
def _kpi_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = kpi.kpi_history(telemetry(spark, sf_dir), period="1 hour")
    return kpi.kpi_metrics(history, ts=F.col("period_start"))


def _freshness_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = quality.freshness_history(telemetry(spark, sf_dir), period_seconds=3600)
    return history.select(
        F.lit(QUALITY_NAMESPACE).alias("namespace"),
        F.lit("DataFreshnessMinutes").alias("metric"),
        F.col("freshness_minutes").cast("double").alias("value"),
        F.lit("None").alias("unit"),
        F.create_map(F.lit("Pipeline"), F.lit("Telemetry")).alias("dimensions"),
        F.col("period_start").alias("ts"),
    )


def _service_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.service_points_from_events(events(spark, sf_dir))


def _ingest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_error_points(_validated(spark, sf_dir), "received_at")


ALARM_POINTS = {
    "high-error-rate": _ingest_points,
    "throttling": _service_points,
    "slow-queries": _service_points,
    "critical-battery-count": _kpi_points,
    "fleet-error-rate": _kpi_points,
    "data-freshness": _freshness_points,
}


def _all_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = None
    for make in dict.fromkeys(ALARM_POINTS.values()):
        part = make(spark, sf_dir)
        points = part if points is None else points.unionByName(part)
    return points


_STATE_COLUMNS = ["alarm", "period_start", "value", "breach", "state"]


def _states(points: DataFrame, *names: str) -> DataFrame:
    return alarms.evaluate_alarms(points, [HOURLY_RULES[name] for name in names])


def _shown_states(states: DataFrame) -> DataFrame:
    return _rounded(states.select(*_STATE_COLUMNS), 2, "value")


def _alarm(name: str, rule: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: _shown_states(_states(ALARM_POINTS[rule](spark, sf_dir), rule))


@_register
def metric_period_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = alarms.metric_period_stat(_service_points(spark, sf_dir), period="30 minutes")
    return _rounded(stats, 2, "sum", "average", "maximum", "minimum")


@_register
def dashboard_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet series per six hours, as the dashboard draws them."""
    stats = alarms.metric_period_stat(
        _kpi_points(spark, sf_dir), period="6 hours", statistics=("Maximum", "Average")
    )
    return _rounded(stats, 5, "maximum", "average")


_alarm("alarm_high_error_rate", "high-error-rate")
_alarm("alarm_throttling", "throttling")
_alarm("alarm_slow_queries", "slow-queries")
_alarm("alarm_critical_battery", "critical-battery-count")
_alarm("alarm_fleet_error_rate", "fleet-error-rate")
_alarm("alarm_data_freshness", "data-freshness")


@_register
def evaluate_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_states(_states(_all_points(spark, sf_dir), *HOURLY_RULES))


# Moments at which the alarms below are evaluated, each on what came since the one before.
PORTIONS = ("2024-01-08 00:00:00", "2024-01-19 12:30:00", "2024-03-01 00:00:00")
STORED_RULES = ("critical-battery-count", "fleet-error-rate", "data-freshness")


@_register
def alarms_carried_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms over the stored metrics in three runs; each reads new periods and what the one before kept."""
    table, kept = _run_folder(spark, "alarms_carried_on")
    tables.append_metrics(_kpi_points(spark, sf_dir).unionByName(_freshness_points(spark, sf_dir)), table)
    rules = [HOURLY_RULES[name] for name in STORED_RULES]
    states, carried = None, None
    for number, until in enumerate(PORTIONS):
        metrics = tables.read_metrics(spark, table)
        since = alarms.look_back(carried, rules) if carried is not None else None
        if since is not None:
            metrics = metrics.where((F.col("date") >= f"{since:%Y-%m-%d}") & (F.col("ts") >= moment_literal(since)))
        runs = alarms.alarm_runs(metrics, rules, carried=carried, until=until)
        alarms.carried_runs(runs, carried).write.parquet(f"{kept}/{number}")
        carried = spark.read.schema(alarms.CARRIED_DDL).parquet(f"{kept}/{number}")
        new = alarms.alarm_periods(runs)
        states = new if states is None else states.unionByName(new)
    return _shown_states(states)


@_register
def consecutive_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = HOURLY_RULES["fleet-error-rate"]
    return alarms.consecutive_breach(_kpi_points(spark, sf_dir), [rule])


@_register
def alarm_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms.alarm_transitions(alarms.alarm_runs(_all_points(spark, sf_dir), list(HOURLY_RULES.values())))


@_register
def alarm_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions of the fleet alarms, sent as JSON and rendered as mails."""
    names = ("critical-battery-count", "fleet-error-rate")
    changes = alarms.alarm_transitions(_states(_kpi_points(spark, sf_dir), *names))
    sent = notify.parse_alarm(alarms.alarm_notifications(changes))
    mails = notify.render_email_text(notify.readable_alarms(sent))
    return mails.select("alarm.AlarmName", "alarm.StateUpdatedTimestamp", "subject", "body_text")


# --- notifications ----------------------------------------------------------------------
def _parsed_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notify.parse_alarm(adapters.alarm_notices_from_events(events(spark, sf_dir)))


@_register
def parse_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_notices(spark, sf_dir).select(
        "event_id",
        "warning",
        F.col("alarm.AlarmName").alias("alarm_name"),
        F.col("alarm.NewStateValue").alias("state"),
        F.col("alarm.StateChangeReason").alias("reason"),
        F.col("alarm.Trigger.MetricName").alias("metric"),
        F.size("alarm.Trigger.Dimensions").alias("dimension_count"),
    )


@_register
def unreadable_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notify.unreadable_alarms(_parsed_notices(spark, sf_dir))


@_register
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms_read = notify.readable_alarms(_parsed_notices(spark, sf_dir))
    return notify.render_chat(alarms_read).select("event_id", "color", "chat")


@_register
def render_email_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms_read = notify.readable_alarms(_parsed_notices(spark, sf_dir))
    return notify.render_email_text(alarms_read).select("event_id", "subject", "body_text")


@_register
def render_email_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms_read = notify.readable_alarms(_parsed_notices(spark, sf_dir))
    return notify.render_email_html(alarms_read).select("event_id", "subject", "body_html")


# --- streams: the whole table as one stream, run to its end --------------------------------
def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    # As a pattern, since a stream's plain path must be a folder; both may be one here.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _finish(query) -> None:
    query.awaitTermination()


def _streamed_windows(spark: SparkSession, sf_dir: str, name: str, copies: int) -> DataFrame:
    table, checkpoint = _run_folder(spark, name)
    stream = adapters.telemetry_from_events(_event_stream(spark, sf_dir))
    stream = stream.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    options = {"deduplicate": copies > 1}
    _finish(jobs.stream_window_stats(stream, table, checkpoint, trigger=jobs.ONCE, **options))
    jobs.finish_windows(telemetry(spark, sf_dir), table, **options)
    rows = spark.read.parquet(table).drop("year", "month", "day", "hour")
    return _window_rows(_without_time_zone(rows, "window_start", "window_end"))


@_register
def stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows: those the stream has finished, and the youngest ones from the table."""
    return _streamed_windows(spark, sf_dir, "stream_window_stats", 1)


@_register
def stream_deduplicated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every event comes twice, by device and time."""
    return _streamed_windows(spark, sf_dir, "stream_deduplicated_windows", 2)


def _ingested(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Table and quarantine that one stream has written."""
    table, checkpoint = _run_folder(spark, name)
    raw = adapters.raw_messages_from_events(_event_stream(spark, sf_dir))
    query = jobs.stream_ingest(raw, table, checkpoint, quarantine=f"{table}_rejects", as_of=INGEST_AS_OF, trigger=jobs.ONCE)
    _finish(query)
    return table, f"{table}_rejects"


@_register
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _ingested(spark, sf_dir, "stream_ingest")
    return _without_time_zone(files.read_telemetry(spark, table), "event_time")


@_register
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = _ingested(spark, sf_dir, "stream_rejects")
    return spark.read.parquet(rejects).groupBy("reject_reason").agg(F.count("*").alias("events"))


@_register
def stream_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of a day, folded from the partial sums that the stream has added up."""
    metrics, checkpoint = _run_folder(spark, "stream_kpis")
    stream = adapters.telemetry_from_events(_event_stream(spark, sf_dir))
    _finish(jobs.stream_kpis(stream, f"{metrics}_partials", metrics, checkpoint, as_of=KPI_DAY_END, trigger=jobs.ONCE))
    return _as_text(_without_time_zone(tables.read_metrics(spark, metrics).drop("date"), "ts"))


@_register
def stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics, checkpoint = _run_folder(spark, "stream_quality")
    ticks = _event_stream(spark, sf_dir)
    _finish(
        jobs.stream_quality(
            ticks, lambda: telemetry(spark, sf_dir), metrics, checkpoint, as_of=QUALITY_AS_OF, trigger=jobs.ONCE
        )
    )
    return _as_text(_without_time_zone(tables.read_metrics(spark, metrics).drop("date"), "ts"))
