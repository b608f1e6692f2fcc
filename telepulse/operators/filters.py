"""Row filters.

Day filters name the partition columns and the event time: the first prunes
folders of the stored table, the second skips row groups. A row of the
partition whose time could not be read belongs to its day and is kept; the
hour filter needs a time.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telepulse.functions.calendar import (
    AsOf,
    between_moments,
    hour_before,
    in_day_partition,
    midnight,
    utc_moment,
)
from telepulse.schema import (
    HIGH_TEMPERATURE,
    LOW_BATTERY_PCT,
    OUTLIER_MAX_TEMPERATURE,
    OUTLIER_MIN_TEMPERATURE,
)


def _within(start: datetime, end: datetime, closed: bool = False) -> Column:
    return F.col("event_time").isNull() | between_moments("event_time", start, end, closed)


def on_day(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Rows of the UTC day of ``as_of``, up to that moment."""
    moment = utc_moment(as_of)
    return df.filter(in_day_partition(moment) & _within(midnight(moment), moment, True))


def on_whole_day(df: DataFrame, *, day: AsOf) -> DataFrame:
    start = midnight(utc_moment(day))
    return df.filter(
        in_day_partition(start) & _within(start, start + timedelta(days=1))
    )


def on_two_days(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Rows of the day of ``as_of``, up to that moment, and of the day before."""
    moment = utc_moment(as_of)
    before = moment - timedelta(days=1)
    days = in_day_partition(moment) | in_day_partition(before)
    return df.filter(days & _within(midnight(before), moment, True))


def in_month(df: DataFrame, *, year: int, month: int) -> DataFrame:
    start = datetime(year, month, 1)
    end = datetime(year + month // 12, month % 12 + 1, 1)
    in_partition = (F.col("year") == f"{start:%Y}") & (F.col("month") == f"{start:%m}")
    return df.filter(in_partition & _within(start, end))


def in_previous_hour(df: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Rows of the last full UTC hour before ``as_of``."""
    start, end = hour_before(as_of)
    return df.filter(in_day_partition(start) & between_moments("event_time", start, end))


def drop_outliers(
    df: DataFrame,
    *,
    column: str = "temperature_celsius",
    low: float = OUTLIER_MIN_TEMPERATURE,
    high: float = OUTLIER_MAX_TEMPERATURE,
) -> DataFrame:
    """Keep readings within [low, high]; NULL and NaN are no readings."""
    return df.filter(F.col(column).between(low, high))


def has_status(df: DataFrame, status: str = "ERROR") -> DataFrame:
    return df.filter(F.col("status") == status)


def latest_per_device_day(df: DataFrame) -> DataFrame:
    """Newest row of each device and day.

    Rows equal in time are ordered by their other columns, so the choice is
    the same in every run. Spark keeps one row per device in each task before
    the shuffle (WindowGroupLimit), so a busy device is not gathered whole.
    """
    rest = [name for name in df.columns if name not in ("event_time", "device_id", "year", "month", "day")]
    newest = Window.partitionBy("year", "month", "day", "device_id").orderBy(
        F.desc("event_time"), *[F.asc_nulls_last(name) for name in rest]
    )
    return df.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")


# Conditions that the views count, as the text that views in the catalog are made of.
ERROR = "status = 'ERROR'"
STOPPED = "speed_mps = 0"
STALLED = f"{STOPPED} AND status = 'ACTIVE'"


def low_battery_sql(limit: float = LOW_BATTERY_PCT) -> str:
    return f"battery_level < {limit!r}"


def hot_sql(limit: float = HIGH_TEMPERATURE) -> str:
    # Spark orders NaN above every number.
    return f"temperature_celsius > {limit!r} AND NOT isnan(temperature_celsius)"


def is_error() -> Column:
    return F.expr(ERROR)


def is_low_battery(limit: float = LOW_BATTERY_PCT) -> Column:
    return F.expr(low_battery_sql(limit))


def is_stopped() -> Column:
    return F.expr(STOPPED)


def is_stalled() -> Column:
    return F.expr(STALLED)


def is_hot(limit: float = HIGH_TEMPERATURE) -> Column:
    return F.expr(hot_sql(limit))
