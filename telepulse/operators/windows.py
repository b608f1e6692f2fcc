"""Tumbling windows per device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf
from telepulse.functions.numeric import exact_mean, round_half_up
from telepulse.operators.filters import drop_outliers, in_previous_hour
from telepulse.schema import OUTLIER_MAX_TEMPERATURE, OUTLIER_MIN_TEMPERATURE, WINDOW_LENGTH

TELEMETRY_MEASURES = ("temperature_celsius", "battery_level", "speed_mps")
SIX_FIELD_MEASURES = ("temperature", "humidity", "pressure")


def window_stats(
    df: DataFrame,
    *,
    key: str = "device_id",
    time: str = "event_time",
    measures: Sequence[str] = TELEMETRY_MEASURES,
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """Average, minimum and maximum of each measure per key and window.

    Windows are epoch-aligned and half-open. The first measure is the
    temperature whose outliers are dropped. Works on batch and streams.
    """
    aggregates = [F.count("*").alias("record_count")]
    for name in measures:
        aggregates += [
            exact_mean(name).alias(f"{name}_avg"),
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
        ]
    kept = drop_outliers(df, column=measures[0])
    stats = kept.groupBy(key, F.window(time, length).alias("window")).agg(*aggregates)
    return stats.select(
        key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[f"{name}_{stat}" for name in measures for stat in ("avg", "min", "max")],
        "record_count",
        F.current_timestamp().alias("processed_at"),
    )


def window_stats_daily(df: DataFrame, **options) -> DataFrame:
    return window_stats(df, length="1 day", **options)


def previous_hour_stats(df: DataFrame, *, as_of: AsOf = None, **options) -> DataFrame:
    """The scheduled job: windows of the last full hour before ``as_of``."""
    return window_stats(in_previous_hour(df, as_of=as_of), **options)


def processing_report(
    df: DataFrame,
    *,
    as_of: AsOf = None,
    key: str = "device_id",
    time: str = "event_time",
    measures: Sequence[str] = TELEMETRY_MEASURES,
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """One row of counts for the scheduled job; zeros where there was no data. Options are those of ``window_stats``."""
    rows = in_previous_hour(df, as_of=as_of)
    per_window = (
        rows.groupBy(key, F.window(time, length))
        .agg(
            F.count("*").alias("records"),
            F.count_if(
                F.col(measures[0]).between(OUTLIER_MIN_TEMPERATURE, OUTLIER_MAX_TEMPERATURE)
            ).alias("kept"),
        )
    )
    return per_window.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records_processed"),
        F.count_if(F.col("kept") > 0).alias("aggregates_created"),
    ).select(
        F.when(F.col("records_processed") > 0, "Processing completed successfully")
        .otherwise("No data to process")
        .alias("message"),
        "records_processed",
        "aggregates_created",
    )


def format_window_row(stats: DataFrame, *, measures: Sequence[str] = TELEMETRY_MEASURES) -> DataFrame:
    """Comma-separated export line of a window, measures with two decimals.

    A window without any reading of a measure has nothing between the commas.
    """
    def epoch_millis(name):
        return F.unix_millis(F.col(name).cast("timestamp")).cast("string")

    def fixed(name):
        text = F.format_string("%.2f", round_half_up(F.col(name).cast("double"), 2))
        return F.when(F.col(name).isNotNull(), text)

    parts = [
        F.col("device_id"),
        epoch_millis("window_start"),
        epoch_millis("window_end"),
        *[fixed(f"{name}_{stat}") for name in measures for stat in ("avg", "min", "max")],
        F.col("record_count").cast("string"),
        F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    ]
    line = F.concat_ws(",", *[F.coalesce(part, F.lit("")) for part in parts])
    return stats.select("device_id", "window_start", line.alias("line"))
