"""Named report queries and ad-hoc SQL.

Reports with a limit order by all their columns, so ties never change the
result; Spark runs them as a top-k per task and merges those.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf
from telepulse.functions.numeric import exact_mean, exact_rounded_mean, round_half_up
from telepulse.operators import filters
from telepulse.operators.filters import has_status, in_month, on_whole_day


def _report_decimal(value: Column, precision: int) -> Column:
    return round_half_up(value, 2).cast(f"decimal({precision},2)")


def telemetry_sample(df: DataFrame, *, year: int, month: int, rows: int = 10) -> DataFrame:
    columns = [
        "device_id",
        "fleet_id",
        "event_time",
        "battery_level",
        "speed_mps",
        "temperature_celsius",
    ]
    order = ["event_time", *[c for c in columns if c != "event_time"]]
    return in_month(df, year=year, month=month).select(*columns).orderBy(*order).limit(rows)


def temperature_statistics(df: DataFrame, *, year: int, month: int, precision: int = 5) -> DataFrame:
    """Temperatures per device and fleet of a month, by device.

    ``precision`` widens the decimals for readings of 1000 degrees and more.
    """
    temperature = F.col("temperature_celsius")
    return (
        in_month(df, year=year, month=month)
        .groupBy("device_id", "fleet_id")
        .agg(
            exact_rounded_mean(temperature, 2).cast(f"decimal({precision},2)").alias("avg_temp"),
            _report_decimal(F.min(temperature), precision).alias("min_temp"),
            _report_decimal(F.max(temperature), precision).alias("max_temp"),
            F.count("*").alias("measurement_count"),
        )
        .orderBy("device_id", "fleet_id")
    )


def speed_and_battery_analysis(df: DataFrame, *, year: int, month: int, rows: int = 10) -> DataFrame:
    return (
        in_month(df, year=year, month=month)
        .groupBy("device_id", "status")
        .agg(
            exact_rounded_mean("speed_mps", 2).cast("decimal(5,2)").alias("avg_speed"),
            exact_rounded_mean("battery_level", 2).cast("decimal(5,2)").alias("avg_battery"),
            F.count("*").alias("readings"),
        )
        .orderBy(F.desc_nulls_last("avg_battery"), "device_id", "status")
        .limit(rows)
    )


def device_status_report(df: DataFrame, *, day: AsOf, rows: int = 20) -> DataFrame:
    columns = ["device_id", "fleet_id", "location_zone", "status", "error_code", "event_time"]
    order = [F.asc_nulls_last(c) for c in columns if c != "event_time"]
    return on_whole_day(df, day=day).select(*columns).orderBy(F.desc("event_time"), *order).limit(rows)


def last_records(df: DataFrame, rows: int = 10) -> DataFrame:
    order = [F.asc_nulls_last(c) for c in df.columns if c != "event_time"]
    return df.orderBy(F.desc("event_time"), *order).limit(rows)


def avg_temp_by_device(df: DataFrame) -> DataFrame:
    temperature = F.col("temperature_celsius")
    return (
        df.groupBy("device_id")
        .agg(
            exact_mean(temperature).alias("avg_temp"),
            F.min(temperature).alias("min_temp"),
            F.max(temperature).alias("max_temp"),
        )
        .orderBy(F.desc_nulls_last("avg_temp"), "device_id")
    )


def device_avg_month(df: DataFrame, *, year: int, month: int) -> DataFrame:
    monthly = in_month(df, year=year, month=month)
    return monthly.groupBy("device_id").agg(exact_mean("temperature_celsius").alias("avg_temp"))


def battery_timeline(df: DataFrame, *, day: AsOf) -> DataFrame:
    rows = on_whole_day(df, day=day).select("device_id", "battery_level", "event_time")
    return rows.orderBy("event_time", "device_id", "battery_level")


def error_events(df: DataFrame, *, year: int, month: int) -> DataFrame:
    rows = has_status(in_month(df, year=year, month=month), "ERROR")
    return rows.select("device_id", "error_code", "event_time").orderBy(
        F.desc("event_time"), "device_id", F.asc_nulls_last("error_code")
    )


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def conditional_counts(df: DataFrame) -> DataFrame:
    """The conditions of the views, counted over everything."""
    return df.agg(
        F.count_if(filters.is_error()).alias("error_events"),
        F.count_if(filters.is_low_battery()).alias("low_battery_events"),
        F.count_if(filters.is_stalled()).alias("stalled_events"),
        F.count_if(filters.is_stopped()).alias("stopped_events"),
        F.count_if(filters.is_hot()).alias("hot_events"),
    )


# Reports that can be asked for by name; each takes its period as keywords.
NAMED_QUERIES: dict[str, Callable[..., DataFrame]] = {
    "device_telemetry_sample": telemetry_sample,
    "temperature_statistics": temperature_statistics,
    "speed_and_battery_analysis": speed_and_battery_analysis,
    "device_status_report": device_status_report,
}


def named_query(df: DataFrame, name: str, **parameters) -> DataFrame:
    if name not in NAMED_QUERIES:
        raise ValueError(f"Unknown query: {name}; known are {', '.join(sorted(NAMED_QUERIES))}")
    return NAMED_QUERIES[name](df, **parameters)


def run_sql(
    spark: SparkSession, query: str | None, *, max_rows: int | None = None, as_text: bool = True
) -> DataFrame:
    """Ad-hoc SQL, values as text as a client sees them; ``max_rows`` limits the rows where it is given.

    A statement that Spark cannot analyse raises with Spark's own message.
    """
    if not query or not query.strip():
        raise ValueError("Missing required field: query")
    result = spark.sql(query.strip())
    if max_rows is not None:
        result = result.limit(max_rows)
    if as_text:
        result = result.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in result.columns])
    return result

