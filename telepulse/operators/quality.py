"""Data-quality checks, their metrics and alerts.

The three checks share one scan of two days and one shuffle by device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf, in_day_partition, midnight, moment_literal, utc_moment
from telepulse.functions.numeric import round_half_to_plus_infinity
from telepulse.operators.filters import on_day, on_two_days
from telepulse.schema import (
    MAX_DEVICE_DROP_PCT,
    NO_DATA_MINUTES,
    NO_DATA_TEXT,
    QUALITY_NAMESPACE,
    STALE_AFTER_MINUTES,
)

ALERT_SEPARATOR = "\n\n---\n\n"


def _minutes_since(last: Column, moment) -> Column:
    seconds = F.timestamp_diff("SECOND", last, moment_literal(moment))
    return F.coalesce(F.floor(seconds / 60), F.lit(NO_DATA_MINUTES)).cast("int")


def _shown(last: Column) -> Column:
    return F.coalesce(F.date_format(last, "yyyy-MM-dd HH:mm:ss"), F.lit(NO_DATA_TEXT))


def _delta_percent(today: Column, yesterday: Column) -> Column:
    change = (today - yesterday) / F.nullif(yesterday, F.lit(0)) * F.lit(100.0)
    return F.coalesce(round_half_to_plus_infinity(change), F.lit(0)).cast("int")


def data_freshness(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Whole minutes since the newest row of today; 9999 and NEVER without one."""
    moment = utc_moment(as_of)
    today = on_day(df, as_of=moment).agg(
        F.max("event_time").alias("last"), F.count("*").alias("record_count")
    )
    return today.select(
        _minutes_since(F.col("last"), moment).alias("freshness_minutes"),
        _shown(F.col("last")).alias("last_seen"),
        "record_count",
    )


def partition_health(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Rows of today, and whether there are any."""
    today = on_day(df, as_of=as_of).agg(F.count("*").alias("today_record_count"))
    return today.withColumn("partition_exists", F.col("today_record_count") > 0)


def _devices_of_two_days(df: DataFrame, moment) -> DataFrame:
    is_today = in_day_partition(moment)
    return (
        on_two_days(df, as_of=moment)
        .groupBy("device_id")
        .agg(
            F.count_if(is_today).alias("rows_today"),
            F.count_if(~is_today).alias("rows_yesterday"),
            F.max(F.when(is_today, F.col("event_time"))).alias("last_today"),
        )
    )


def device_count_regression(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Devices of today and yesterday and the change in whole percent."""
    counts = _devices_of_two_days(df, utc_moment(as_of)).agg(
        F.count_if(F.col("rows_today") > 0).alias("today_count"),
        F.count_if(F.col("rows_yesterday") > 0).alias("yesterday_count"),
    )
    return counts.withColumn(
        "delta_percent", _delta_percent(F.col("today_count"), F.col("yesterday_count"))
    )


def quality_checks(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """All three checks as one row."""
    moment = utc_moment(as_of)
    totals = _devices_of_two_days(df, moment).agg(
        F.max("last_today").alias("last"),
        F.coalesce(F.sum("rows_today"), F.lit(0)).alias("today_record_count"),
        F.count_if(F.col("rows_today") > 0).alias("today_count"),
        F.count_if(F.col("rows_yesterday") > 0).alias("yesterday_count"),
    )
    return totals.select(
        _minutes_since(F.col("last"), moment).alias("freshness_minutes"),
        _shown(F.col("last")).alias("last_seen"),
        "today_record_count",
        (F.col("today_record_count") > 0).alias("partition_exists"),
        "today_count",
        "yesterday_count",
        _delta_percent(F.col("today_count"), F.col("yesterday_count")).alias("delta_percent"),
    )


def freshness_history(df: DataFrame, *, period_seconds: int = 1800, end: AsOf = None) -> DataFrame:
    """What the freshness check finds at the end of each period of each day, from the first day seen to the last, or
    to the day of ``end``. A day without telemetry has all its periods, with 9999 minutes.

    Rows are folded to one per period; a period looks back by a window over those of its day.
    """
    if not 60 <= period_seconds <= 86400 or 86400 % period_seconds:
        raise ValueError("period_seconds must be 60 at least and divide a day")
    length = F.lit(period_seconds)
    seconds = F.unix_seconds(F.col("event_time").cast("timestamp"))
    latest = df.where("event_time IS NOT NULL").groupBy((seconds - F.pmod(seconds, length)).alias("period")).agg(
        F.max(seconds).alias("last")
    )
    start_of_day = F.col("period") - F.pmod("period", F.lit(86400))
    last_day = F.max(start_of_day)
    if end is not None:
        last_day = F.greatest(last_day, F.unix_seconds(moment_literal(midnight(utc_moment(end))).cast("timestamp")))
    span = latest.agg(F.min(start_of_day).alias("first"), last_day.alias("until"))
    grid = span.where("first IS NOT NULL").select(
        F.explode(F.sequence("first", F.col("until") + F.lit(86400) - length, length)).alias("period")
    )
    so_far = Window.partitionBy(start_of_day).orderBy("period")
    seen = F.max("last").over(so_far)
    return grid.join(latest, "period", "left").select(
        F.timestamp_seconds("period").cast("timestamp_ntz").alias("period_start"),
        F.coalesce(F.floor((F.col("period") + length - seen) / 60), F.lit(NO_DATA_MINUTES))
        .cast("int")
        .alias("freshness_minutes"),
    )


def quality_metrics(checks: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Four metric rows of the checks."""
    # --- fixed values: metric names and units ---
    points = [
        # Published and drawn as 9999 at most, the value of "never".
        ("DataFreshnessMinutes", F.least("freshness_minutes", F.lit(NO_DATA_MINUTES)), "None"),
        ("TodayPartitionExists", F.col("partition_exists").cast("int"), "Count"),
        ("ActiveDeviceCount", F.col("today_count"), "Count"),
        ("DeviceCountDeltaPct", F.col("delta_percent"), "Percent"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"), value.cast("double").alias("value"), F.lit(unit).alias("unit")
            )
            for metric, value, unit in points
        ]
    )
    return checks.select(F.inline(rows)).select(
        F.lit(QUALITY_NAMESPACE).alias("namespace"),
        "metric",
        "value",
        "unit",
        F.create_map(F.lit("Pipeline"), F.lit("Telemetry")).alias("dimensions"),
        moment_literal(utc_moment(as_of)).alias("ts"),
    )


def _alerts(
    stale_after: int = STALE_AFTER_MINUTES, max_drop: int = MAX_DEVICE_DROP_PCT
) -> list[tuple[str, Column]]:
    """Check name and its alert text, NULL where the check passed."""

    def number(name: str) -> Column:
        return F.col(name).cast("string")

    # Headings and labels are fixed values; the advice is this project's own.
    stale = F.concat(
        F.lit("🚨 DATA FRESHNESS ALERT\nLast telemetry received: "),
        F.col("last_seen"),
        F.lit("\nStaleness: "),
        number("freshness_minutes"),
        F.lit(" minutes\nNext step: see whether devices still send and whether their messages are rejected."),
    )
    missing = F.lit(
        "⚠️ MISSING PARTITION ALERT\nNo data found for today's partition (year/month/day).\n"
        "Next step: list the table's folders and register the ones that are missing."
    )
    dropped = F.concat(
        F.lit("⚠️ DEVICE COUNT REGRESSION\nYesterday: "),
        number("yesterday_count"),
        F.lit(" devices\nToday:     "),
        number("today_count"),
        F.lit(" devices\nDrop:      "),
        F.abs("delta_percent").cast("string"),
        F.lit("%\nNext step: compare the silent devices by fleet and zone."),
    )
    fell = (F.col("yesterday_count") > 0) & (F.col("delta_percent") < -max_drop)
    return [
        ("freshness", F.when(F.col("freshness_minutes") > stale_after, stale)),
        ("partition", F.when(~F.col("partition_exists"), missing)),
        ("device_count", F.when(fell, dropped)),
    ]


def quality_alerts(checks: DataFrame, **thresholds: int) -> DataFrame:
    """One row per failed check."""
    alerts = F.array(
        *[F.struct(F.lit(name).alias("check"), text.alias("text")) for name, text in _alerts(**thresholds)]
    )
    return checks.select(F.inline(alerts)).filter(F.col("text").isNotNull())


def consolidated_alert(checks: DataFrame, **thresholds: int) -> DataFrame:
    """One message with all failed checks; no row if none failed."""
    texts = F.array_compact(F.array(*[text for _, text in _alerts(**thresholds)]))
    return (
        checks.select(texts.alias("texts"))
        .filter(F.size("texts") > 0)
        .select(
            F.concat(
                F.lit("Telemetry Data Quality Issue ("),
                F.size("texts").cast("string"),
                F.lit(" check(s) failed)"),
            ).alias("subject"),
            F.array_join("texts", ALERT_SEPARATOR).alias("message"),
        )
    )


def quality_report(checks: DataFrame, **thresholds: int) -> DataFrame:
    """The outcome of the checks as one JSON text."""
    fired = F.size(F.array_compact(F.array(*[text for _, text in _alerts(**thresholds)])))
    report = F.struct(
        F.lit(3).alias("checksRun"),
        fired.alias("alertsFired"),
        F.struct(
            F.col("freshness_minutes").alias("freshnessMinutes"), F.col("last_seen").alias("lastSeen")
        ).alias("freshness"),
        F.struct(
            F.col("today_record_count").alias("todayRecordCount"),
            F.col("partition_exists").alias("partitionExists"),
        ).alias("partition"),
        F.struct(
            F.col("today_count").alias("todayCount"),
            F.col("yesterday_count").alias("yesterdayCount"),
            F.col("delta_percent").alias("deltaPercent"),
        ).alias("deviceCount"),
    )
    return checks.select(F.to_json(report).alias("report"))
