"""UTC calendar: as-of moments, partition values, hours.

An as-of moment is a Python value, so predicates built from it are literals
that Catalyst folds, prunes partitions with and pushes into the scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | date | str | None


def utc_moment(as_of: AsOf = None) -> datetime:
    """Naive UTC datetime of ``as_of``; None is now, naive values are UTC."""
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    elif isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    elif not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of


def midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


def hour_before(as_of: AsOf = None) -> tuple[datetime, datetime]:
    """Half-open bounds of the last full hour before ``as_of``."""
    end = utc_moment(as_of).replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


def moment_literal(moment: AsOf) -> Column:
    """Literal comparable to TIMESTAMP_NTZ and, in a UTC session, TIMESTAMP."""
    return F.expr(f"TIMESTAMP_NTZ '{utc_moment(moment):%Y-%m-%d %H:%M:%S.%f}'")


def in_day_partition(moment: datetime) -> Column:
    """Predicate on the partition columns for the day of ``moment``."""
    return (
        (F.col("year") == f"{moment:%Y}")
        & (F.col("month") == f"{moment:%m}")
        & (F.col("day") == f"{moment:%d}")
    )


def between_moments(column: str, start: datetime, end: datetime, closed: bool = False) -> Column:
    upper = F.col(column) <= moment_literal(end) if closed else F.col(column) < moment_literal(end)
    return (F.col(column) >= moment_literal(start)) & upper


def with_partition_columns(df: DataFrame, column: str = "event_time", hour: bool = False) -> DataFrame:
    """Add zero-padded year, month, day (and hour) text of a time column."""
    # One date-to-text cast, cut three times: cheaper than three formatters.
    text = F.col(column).cast("date").cast("string")
    parts = {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 6, 2),
        "day": F.substring(text, 9, 2),
    }
    if hour:
        parts["hour"] = F.lpad(F.hour(column).cast("string"), 2, "0")
    return df.withColumns(parts)


def lenient_timestamp(text: Column) -> Column:
    """Timestamp of ISO or space-separated text with a full date; NULL where it is neither.

    A time alone would fall on the day of the run, a year alone on its first day.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[T ].*)?$"), text.try_cast("timestamp"))


def display_time(text: Column) -> Column:
    """Month/day/year with a 12-hour clock, as messages show it."""
    shown = F.date_format(lenient_timestamp(text), "M/d/yyyy, h:mm:ss a")
    return F.coalesce(shown, F.lit("Invalid Date"))
