"""Fleet KPIs and their metric rows.

KPIs average the rounded daily averages of each (fleet, device) pair, each
pair counting once; that is how they are defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf, in_day_partition, moment_literal, utc_moment, with_partition_columns
from telepulse.functions.numeric import AVERAGE, percentage, rounded_mean
from telepulse.operators.filters import on_day
from telepulse.operators.health import device_measures, device_sums, measures_of_sums, merged_sums
from telepulse.schema import FLEET_NAMESPACE, LOW_BATTERY_PCT, PARTITION_COLUMNS

ALL_FLEETS = "ALL"

# --- fixed values: published metrics, their KPI and unit ----------------------
_PUBLISHED = [
    ("ActiveDeviceCount", "active_device_count", "Count"),
    ("ErrorDeviceCount", "error_device_count", "Count"),
    ("CriticalBatteryCount", "critical_battery_count", "Count"),
    ("FleetErrorRatePct", "fleet_error_rate_pct", "Percent"),
    ("AvgBatteryLevel", "fleet_avg_battery", "Percent"),
    ("AvgTemperatureCelsius", "fleet_avg_temp", "None"),
]


def _kpis(measures: DataFrame, keys: list[str], low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """KPIs per key from device measures.

    Folding to one row per device turns each distinct count into a plain one. Rounded averages add up as decimals,
    so their mean does not depend on the order of rows.
    """
    per_device = measures.groupBy(*keys, "device_id").agg(
        F.sum("error_count").alias("errors"),
        F.sum("session_count").alias("sessions"),
        F.min("min_battery_pct").alias("battery_min"),
        F.sum(F.col("avg_battery_pct").cast(AVERAGE)).alias("battery_sum"),
        F.count("avg_battery_pct").alias("battery_count"),
        F.sum(F.col("avg_temp_celsius").cast(AVERAGE)).alias("temperature_sum"),
        F.count("avg_temp_celsius").alias("temperature_count"),
    )
    known = F.col("device_id").isNotNull()
    return per_device.groupBy(*keys).agg(
        F.count_if(known).alias("active_device_count"),
        F.sum("errors").alias("total_error_events"),
        F.count_if(known & (F.col("errors") > 0)).alias("error_device_count"),
        F.count_if(known & (F.col("battery_min") < low_battery)).alias("critical_battery_count"),
        rounded_mean(F.sum("battery_sum"), F.sum("battery_count"), 1).alias("fleet_avg_battery"),
        rounded_mean(F.sum("temperature_sum"), F.sum("temperature_count"), 1).alias(
            "fleet_avg_temp"
        ),
        percentage(F.sum("errors"), F.sum("sessions")).alias("fleet_error_rate_pct"),
    )


def fleet_kpis(df: DataFrame, *, as_of: AsOf = None, low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """One row of KPIs for the UTC day of ``as_of``; NULLs and zeros without data."""
    return _kpis(device_measures(on_day(df, as_of=as_of), []), [], low_battery)


PARTIAL_KEYS = [*PARTITION_COLUMNS, "period_start", "fleet_id", "device_id"]


def kpi_partials(df: DataFrame, *, period: str = "5 minutes") -> DataFrame:
    """Sums that KPIs can be folded from, per day, period, fleet and device; those of several batches add up."""
    start = F.window(F.col("event_time").cast("timestamp_ntz"), period)["start"]
    rows = with_partition_columns(df).where("event_time IS NOT NULL").withColumn("period_start", start.cast("timestamp_ntz"))
    return device_sums(rows, PARTIAL_KEYS)


def add_up(partials: DataFrame) -> DataFrame:
    return merged_sums(partials, PARTIAL_KEYS)


def kpis_of_partials(partials: DataFrame, *, as_of: AsOf = None, low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """``fleet_kpis`` of the UTC day of ``as_of``, of the periods that have begun by then."""
    moment = utc_moment(as_of)
    begun = partials.where(in_day_partition(moment) & (F.col("period_start") <= moment_literal(moment)))
    return _kpis(measures_of_sums(merged_sums(begun, ["fleet_id", "device_id"]), []), [], low_battery)


def fleet_kpis_by_fleet(
    df: DataFrame, *, as_of: AsOf = None, low_battery: float = LOW_BATTERY_PCT
) -> DataFrame:
    """The same per fleet, and over all fleets as ``ALL``."""
    measures = device_measures(on_day(df, as_of=as_of), [])
    both = F.explode(F.array(F.col("fleet_id"), F.lit(ALL_FLEETS)))
    return _kpis(measures.withColumn("fleet", both), ["fleet"], low_battery)


def kpi_history(df: DataFrame, *, period: str = "1 day", low_battery: float = LOW_BATTERY_PCT) -> DataFrame:
    """KPIs of the day so far at the end of each period (which must divide a day), as the scheduled job publishes them.

    Every period from the first day seen to the last is there; before a day's first row, counts are 0.

    A device changes the KPIs only in periods in which it reports. So each (fleet, device) keeps running sums over
    its own periods, the change to its published averages is what a period adds, and a day's few periods are summed
    up last. Sums of rounded averages are decimals, which add up exactly. A device is counted from the first period
    in which it reports, fails or falls below the limit.
    """
    day = F.col("event_time").cast("date")
    start = F.window("event_time", period)["start"].cast("timestamp_ntz")
    rows = df.where("event_time IS NOT NULL").withColumns({"kpi_day": day, "kpi_period": start})
    sums = device_sums(rows, ["kpi_day", "kpi_period", "fleet_id", "device_id"])
    # Dealt by day and device, all three windows need no further shuffle.
    sums = sums.repartition("kpi_day", "device_id")
    so_far = Window.partitionBy("kpi_day", "device_id", "fleet_id").orderBy("kpi_period")
    of_device = Window.partitionBy("kpi_day", "device_id").orderBy("kpi_period", "fleet_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = lambda c: F.sum(c).over(so_far)

    def published(name: str) -> Column:
        average = rounded_mean(total(f"{name}_sum"), total(f"{name}_count"), 1)
        return average.cast(AVERAGE)

    def first(is_so: Column) -> Column:
        """1 in the first row of a device's day that is so."""
        is_so = F.coalesce(is_so, F.lit(False)) & F.col("device_id").isNotNull()
        return (is_so & (F.count_if(is_so).over(of_device) == 1)).cast("int")

    states = sums.select(
        "kpi_day", "kpi_period", "fleet_id", "device_id", "events", "errors",
        published("battery").alias("battery"),
        published("temperature").alias("temperature"),
        first(F.lit(True)).alias("seen"),
        first(F.col("errors") > 0).alias("failed"),
        first(F.col("battery_min") < low_battery).alias("low"),
    )
    zero = F.lit(0).cast(AVERAGE)

    def change(name: str) -> tuple[Column, Column]:
        before = F.lag(name).over(so_far)
        new = F.col(name).isNotNull().cast("int") - before.isNotNull().cast("int")
        return F.coalesce(F.col(name), zero) - F.coalesce(before, zero), new

    battery, temperature = change("battery"), change("temperature")
    moved = states.withColumns(
        {"battery_d": battery[0], "battery_n": battery[1], "temperature_d": temperature[0], "temperature_n": temperature[1]}
    )
    measures = ("events", "errors", "battery_d", "battery_n", "temperature_d", "temperature_n", "seen", "failed", "low")
    added = moved.groupBy("kpi_day", "kpi_period").agg(*[F.sum(c).alias(c) for c in measures])
    grid = rows.agg(F.min("kpi_day").alias("first"), F.max("kpi_day").alias("until")).where("first IS NOT NULL").select(
        F.explode(F.expr("sequence(first, until, interval 1 day)")).alias("kpi_day")
    )
    grid = grid.select(
        "kpi_day",
        F.explode(
            F.expr(
                f"sequence(cast(kpi_day AS timestamp_ntz), cast(kpi_day AS timestamp_ntz) + interval 1 day - interval {period}, "
                f"interval {period})"
            )
        ).alias("kpi_period"),
    )
    keys = ["kpi_day", "kpi_period"]
    of_day = Window.partitionBy("kpi_day").orderBy("kpi_period")
    running = lambda c: F.coalesce(F.sum(c).over(of_day), F.lit(0))
    whole = grid.join(added, keys, "left")
    return whole.select(
        F.col("kpi_period").alias("period_start"),
        running("seen").alias("active_device_count"),
        F.sum("errors").over(of_day).alias("total_error_events"),
        running("failed").alias("error_device_count"),
        running("low").alias("critical_battery_count"),
        rounded_mean(running("battery_d"), running("battery_n"), 1).alias("fleet_avg_battery"),
        rounded_mean(running("temperature_d"), running("temperature_n"), 1).alias("fleet_avg_temp"),
        percentage(running("errors"), running("events")).alias("fleet_error_rate_pct"),
    )


def kpi_metrics(kpis: DataFrame, *, as_of: AsOf = None, ts: Column | None = None) -> DataFrame:
    """One metric row per published KPI; what is not there is published as 0.

    The stamp is column ``ts`` if given (such as a period start), else ``as_of``.
    """
    stamp = moment_literal(utc_moment(as_of)) if ts is None else ts
    fleet = F.col("fleet") if "fleet" in kpis.columns else F.lit(ALL_FLEETS)
    points = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.coalesce(F.col(kpi).cast("double"), F.lit(0.0)).alias("value"),
                F.lit(unit).alias("unit"),
            )
            for metric, kpi, unit in _PUBLISHED
        ]
    )
    return kpis.select(
        F.create_map(F.lit("Fleet"), fleet).alias("dimensions"), stamp.alias("ts"), F.inline(points)
    ).select(F.lit(FLEET_NAMESPACE).alias("namespace"), "metric", "value", "unit", "dimensions", "ts")
