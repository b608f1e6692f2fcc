"""Daily health of fleets, devices and zones.

Definitions are SQL text, so that an operator over a frame and a view in the
catalog are made of the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telepulse.functions.numeric import exact_sql, percentage_sql, rounded_mean, rounded_mean_sql
from telepulse.operators.filters import ERROR, STALLED, STOPPED, hot_sql, low_battery_sql
from telepulse.schema import HIGH_TEMPERATURE, LOW_BATTERY_PCT, PARTITION_COLUMNS


def _aggregates(columns: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in columns.items()]


def _select(keys: list[str], columns: dict[str, str], source: str) -> str:
    found = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {', '.join(keys)}, {found} FROM {source} GROUP BY {', '.join(keys)}"


def _mean_of(column: str, digits: int) -> str:
    return rounded_mean_sql(f"sum({exact_sql(column)})", f"count({exact_sql(column)})", digits)


# --- fleets ------------------------------------------------------------------
FLEET_KEYS = [*PARTITION_COLUMNS, "fleet_id"]


def _fleet_columns(low_battery: float, high_temperature: float) -> dict[str, str]:
    return {
        "total_events": "count(*)",
        "active_devices": "count(DISTINCT device_id)",
        "error_count": f"count_if({ERROR})",
        "error_rate_pct": percentage_sql(f"count_if({ERROR})", "count(*)"),
        "avg_battery_pct": _mean_of("battery_level", 1),
        "critical_battery_events": f"count_if({low_battery_sql(low_battery)})",
        "min_battery_pct": "min(battery_level)",
        "avg_speed_mps": _mean_of("speed_mps", 2),
        "stalled_events": f"count_if({STALLED})",
        "avg_temp_celsius": _mean_of("temperature_celsius", 1),
        "max_temp_celsius": "max(temperature_celsius)",
        "high_temp_events": f"count_if({hot_sql(high_temperature)})",
    }


def fleet_daily_health(
    df: DataFrame, *, low_battery: float = LOW_BATTERY_PCT, high_temperature: float = HIGH_TEMPERATURE
) -> DataFrame:
    """One row per day and fleet.

    The single distinct count is split by Spark over (day, fleet, device)
    first, so a fleet with most of the rows is spread over tasks.
    """
    return df.groupBy(*FLEET_KEYS).agg(*_aggregates(_fleet_columns(low_battery, high_temperature)))


# --- sums per device -----------------------------------------------------------
def _sum_columns(low_battery: float) -> dict[str, str]:
    sums = {
        "last_seen": "max(event_time)",
        "events": "count(*)",
        "errors": f"count_if({ERROR})",
        "battery_min": "min(battery_level)",
        "low_batteries": f"count_if({low_battery_sql(low_battery)})",
        "temperature_max": "max(temperature_celsius)",
        "stops": f"count_if({STOPPED})",
    }
    for measure, column in (("battery", "battery_level"), ("temperature", "temperature_celsius"), ("speed", "speed_mps")):
        sums[f"{measure}_count"] = f"count({exact_sql(column)})"
        sums[f"{measure}_sum"] = f"sum({exact_sql(column)})"
    return sums


def device_sums(df: DataFrame, keys: list[str], low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """Mergeable measures per key; all buffers are numbers, so this is a hash
    aggregate with map-side combine. Columns nobody reads are pruned. Sums are
    exact, so they can be added up in any order and by any grouping."""
    return df.groupBy(*keys).agg(*_aggregates(_sum_columns(low_battery)))


def merged_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of sums per key, of the same types."""
    kinds = dict(sums.dtypes)

    def add(name: str) -> Column:
        return {"last_seen": F.max, "battery_min": F.min, "temperature_max": F.max}.get(name, F.sum)(name)

    return sums.groupBy(*keys).agg(*[add(name).cast(kinds[name]).alias(name) for name in _sum_columns(0)])


def _mean_of_sums(measure: str, digits: int) -> str:
    return rounded_mean_sql(f"sum({measure}_sum)", f"sum({measure}_count)", digits)


# --- devices -------------------------------------------------------------------
DEVICE_KEYS = [*PARTITION_COLUMNS, "fleet_id", "device_id"]
_DEVICE_COLUMNS = {
    "last_seen": "max(last_seen)",
    "session_count": "sum(events)",
    "error_count": "sum(errors)",
    "error_rate_pct": percentage_sql("sum(errors)", "sum(events)"),
    "last_status": "max(status)",
    "latest_status": "max_by(status, struct(last_seen, status))",
    "avg_battery_pct": _mean_of_sums("battery", 1),
    "min_battery_pct": "min(battery_min)",
    "avg_temp_celsius": _mean_of_sums("temperature", 1),
    "max_temp_celsius": "max(temperature_max)",
    "avg_speed_mps": _mean_of_sums("speed", 2),
}


def device_status_summary(df: DataFrame) -> DataFrame:
    """One row per day, fleet and device.

    ``last_status`` is the alphabetically last status; ``latest_status`` is
    that of the newest row. A maximum of text cannot be hash-aggregated, so
    rows are first folded per status and only those few are sorted.
    """
    return device_sums(df, [*DEVICE_KEYS, "status"]).groupBy(*DEVICE_KEYS).agg(*_aggregates(_DEVICE_COLUMNS))


def device_measures(df: DataFrame, keys: list[str]) -> DataFrame:
    """The part of the device summary that KPIs read, in one shuffle."""
    return measures_of_sums(device_sums(df, [*keys, "fleet_id", "device_id"]), keys)


def measures_of_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    battery = rounded_mean(F.col("battery_sum"), F.col("battery_count"), 1)
    temperature = rounded_mean(F.col("temperature_sum"), F.col("temperature_count"), 1)
    return sums.select(
        *keys,
        "fleet_id",
        "device_id",
        F.col("events").alias("session_count"),
        F.col("errors").alias("error_count"),
        F.col("battery_min").alias("min_battery_pct"),
        battery.alias("avg_battery_pct"),
        temperature.alias("avg_temp_celsius"),
    )


# --- zones ---------------------------------------------------------------------
ZONE_KEYS = [*PARTITION_COLUMNS, "location_zone"]
_ZONE_COLUMNS = {
    "total_events": "sum(events)",
    "unique_devices": "count(DISTINCT device_id)",
    "fleet_count": "count(DISTINCT fleet_id)",
    "error_count": "sum(errors)",
    "error_rate_pct": percentage_sql("sum(errors)", "sum(events)"),
    "avg_speed_mps": _mean_of_sums("speed", 2),
    "stopped_events": "sum(stops)",
    "avg_battery_pct": _mean_of_sums("battery", 1),
    "low_battery_count": "sum(low_batteries)",
}


def zone_activity(df: DataFrame, *, low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """One row per day and zone.

    Two distinct counts make Spark copy every row per count; folding to
    (zone, device, fleet) first leaves little to copy.
    """
    sums = device_sums(df, [*ZONE_KEYS, "device_id", "fleet_id"], low_battery)
    return sums.groupBy(*ZONE_KEYS).agg(*_aggregates(_ZONE_COLUMNS))


def view_sql(source: str) -> dict[str, str]:
    """The three views over a table, as text that the catalog keeps; of the operators' own definitions."""
    sums = _sum_columns(LOW_BATTERY_PCT)
    return {
        "fleet_daily_health": _select(FLEET_KEYS, _fleet_columns(LOW_BATTERY_PCT, HIGH_TEMPERATURE), source),
        "device_status_summary": _select(DEVICE_KEYS, _DEVICE_COLUMNS, f"({_select([*DEVICE_KEYS, 'status'], sums, source)})"),
        "zone_activity": _select(ZONE_KEYS, _ZONE_COLUMNS, f"({_select([*ZONE_KEYS, 'device_id', 'fleet_id'], sums, source)})"),
    }


def _event_date() -> Column:
    return F.concat_ws("-", *PARTITION_COLUMNS).alias("event_date")


def bi_fleet_daily_health(df: DataFrame) -> DataFrame:
    """Fleet health with the column types and date of the BI dataset."""
    view = fleet_daily_health(df)
    return view.withColumn("min_battery_pct", F.col("min_battery_pct").cast("double")).select(
        "*", _event_date()
    )


def bi_device_status_summary(df: DataFrame) -> DataFrame:
    """Device summary with the column types of the BI dataset and a date."""
    view = device_status_summary(df).drop("latest_status")
    return view.withColumns(
        {
            "last_seen": F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"),
            "min_battery_pct": F.col("min_battery_pct").cast("double"),
        }
    ).select("*", _event_date())
