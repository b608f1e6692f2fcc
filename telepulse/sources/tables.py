"""Table writers, partition maintenance and the catalog views."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf, in_day_partition, midnight, moment_literal, utc_moment, with_partition_columns
from telepulse.functions.text import dimension_key
from telepulse.operators import health, kpi
from telepulse.schema import (
    METRICS_COLUMNS,
    METRICS_DDL,
    PARTITION_COLUMNS,
    PARTITION_DDL,
    TELEMETRY_COLUMNS,
    TELEMETRY_DDL,
    TELEMETRY_RETENTION_DAYS,
)
from telepulse.sources import keyed
from telepulse.sources.files import folders, path_exists, remove_folder


def write_raw(df: DataFrame, path: str) -> None:
    """Append telemetry to the day-partitioned Parquet table at ``path``.

    Rows are rebalanced by day and hour: AQE splits a busy hour over several
    tasks and packs quiet ones together, and a file holds few hours, so its
    statistics let an hour query skip it.
    """
    _telemetry_layout(df).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def merge_raw(df: DataFrame, path: str, *newest: Column) -> None:
    """Write telemetry to the table so that a device has one row a millisecond: the last one written.

    Of several in one batch the one with the largest ``newest`` stays (such as the offset of a message), then the first
    by all columns. Only the days of the batch are read and written.
    """
    rows = with_partition_columns(df.withColumn("event_time", F.col("event_time").cast("timestamp")))
    moment = F.date_trunc("millisecond", "event_time")
    keyed.merge(
        rows, path, f"{TELEMETRY_DDL}, {PARTITION_DDL}", [*PARTITION_COLUMNS, "device_id", moment], PARTITION_COLUMNS, newest=newest
    )


def append_to_table(df: DataFrame, table: str) -> None:
    """The same into a catalog table made by ``create_telemetry_table``."""
    _telemetry_layout(df).write.insertInto(table)


def _telemetry_layout(df: DataFrame) -> DataFrame:
    rows = with_partition_columns(df.withColumn("event_time", F.col("event_time").cast("timestamp")))
    rows = rows.select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS)
    return rows.withColumn("hour", F.hour("event_time")).hint(
        "rebalance", *PARTITION_COLUMNS, "hour"
    ).drop("hour")


WINDOW_PARTITIONS = [*PARTITION_COLUMNS, "hour"]


def merge_window_stats(stats: DataFrame, path: str) -> None:
    """Write window rows by device and window: others of the same hour stay."""
    rows = with_partition_columns(stats, "window_start", hour=True)
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    keyed.merge(rows, path, schema, [*WINDOW_PARTITIONS, "device_id", "window_start"], WINDOW_PARTITIONS)


def write_window_stats(stats: DataFrame, path: str) -> None:
    """Write window rows; running the same hours again replaces them."""
    keys = [*PARTITION_COLUMNS, "hour"]
    rows = with_partition_columns(stats, "window_start", hour=True)
    (
        rows.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


# --- partial sums, as snapshots of days ---------------------------------------
def _snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def _latest(snapshots: DataFrame, before: int) -> DataFrame:
    """Of each day the rows of its last snapshot before a batch; the folders' names tell, no data is read for it."""
    days = snapshots.where(F.col("batch") < before).select(*PARTITION_COLUMNS, "batch").groupBy(*PARTITION_COLUMNS).agg(
        F.max("batch").alias("batch")
    )
    wanted = [(*row[:3], str(row.batch)) for row in days.collect()]
    return snapshots.where(keyed.in_partitions(wanted, [*PARTITION_COLUMNS, "batch"]))


def add_partials(sums: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch's sums to those of its days: the last snapshot before the batch and the batch make the next one.

    A batch that runs again makes the same snapshot again. The snapshots of a stream that the next one has replaced
    are removed but for the last, which a repeated batch starts from.
    """
    spark = sums.sparkSession
    schema = ", ".join(f"{name} {kind}" for name, kind in sums.dtypes)
    days = [tuple(row) for row in sums.select(*PARTITION_COLUMNS).distinct().collect()]
    if not days:
        return
    rows = sums
    if path_exists(spark, path):
        there = _snapshots(spark, path, schema).where(keyed.in_partitions(days, PARTITION_COLUMNS))
        rows = rows.unionByName(_latest(there, batch_id).drop("batch"))
    (
        kpi.add_up(rows)
        .withColumn("batch", F.lit(batch_id).cast("long"))
        .hint("rebalance", *PARTITION_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS, "batch")
        .parquet(path)
    )
    for year, month, day in days:
        folder = f"{path.rstrip('/')}/year={year}/month={month}/day={day}"
        batches = sorted(int(name.rpartition("batch=")[2]) for name in folders(spark, folder) if "batch=" in name)
        for old in [b for b in batches if b < batch_id][:-1]:
            remove_folder(spark, f"{folder}/batch={old}")


def read_partials(spark: SparkSession, path: str, as_of: AsOf = None, *, up_to: int = 1 << 60) -> DataFrame:
    """The sums of the day of ``as_of`` after batch ``up_to``; no rows where there are none."""
    empty = kpi.kpi_partials(spark.createDataFrame([], TELEMETRY_DDL))
    if not path_exists(spark, path):
        return empty
    schema = ", ".join(f"{name} {kind}" for name, kind in empty.dtypes)
    of_day = _snapshots(spark, path, schema).where(in_day_partition(utc_moment(as_of)))
    return _latest(of_day, up_to + 1).drop("batch")


METRICS_TABLE_DDL = f"{METRICS_DDL}, date string"
METRICS_PARTITIONS = ["namespace", "date"]


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add metric rows to the table, partitioned by namespace and date; a point (metric, dimensions, time) is there once.

    A point that is published again replaces what was there. The days of the batch are read, merged and written
    again, so a day has as many files as its size asks for, however often it is published to.
    """
    rows = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    keys = [*METRICS_PARTITIONS, "metric", dimension_key(F.col("dimensions")), "ts"]
    keyed.merge(rows, path, METRICS_TABLE_DDL, keys, METRICS_PARTITIONS)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric rows with their ``date``, on which a filter prunes folders; empty where none was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS_TABLE_DDL)
    return spark.read.schema(METRICS_TABLE_DDL).parquet(path).select(*METRICS_COLUMNS, "date")


def export_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Export rows in column order as comma-separated text, NULL as nothing."""
    df.write.mode("overwrite").option("header", header).option("nullValue", "").option(
        "emptyValue", ""
    ).csv(path)


def create_telemetry_table(spark: SparkSession, table: str, path: str) -> None:
    """Register the partitioned table over ``path``."""
    columns = f"{TELEMETRY_DDL}, {PARTITION_DDL}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'"
    )


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders that were written beside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Registered partitions of a catalog table, from its metadata."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def list_partitions(df: DataFrame) -> DataFrame:
    """Days present in a frame that is no catalog table."""
    return df.select(*PARTITION_COLUMNS).distinct()


def create_views(spark: SparkSession, source: str | DataFrame) -> None:
    """Create or replace the three health views.

    Over a table's name they are views of the catalog: SQL text, read by any session until they are dropped. Over a
    frame they last as long as the session.
    """
    if isinstance(source, DataFrame):
        for view in (health.fleet_daily_health, health.device_status_summary, health.zone_activity):
            view(source).createOrReplaceTempView(view.__name__)
    else:
        for name, sql in health.view_sql(source).items():
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def retention(
    df: DataFrame,
    *,
    as_of: AsOf = None,
    days: int = TELEMETRY_RETENTION_DAYS,
    column: str = "event_time",
) -> DataFrame:
    """Rows whose day is less than ``days`` days before the day of ``as_of``."""
    cutoff = midnight(utc_moment(as_of)) - timedelta(days=days - 1)
    return df.filter(F.col(column) >= moment_literal(cutoff))


def drop_expired_partitions(
    spark: SparkSession, table: str, *, as_of: AsOf = None, days: int = TELEMETRY_RETENTION_DAYS
) -> list[str]:
    """Drop the day partitions that ``retention`` would no longer keep.

    Reads the catalog only: one name per day is looked at, no data.
    """
    cutoff = f"{midnight(utc_moment(as_of)) - timedelta(days=days - 1):%Y-%m-%d}"
    expired = (
        show_partitions(spark, table)
        .filter(F.regexp_replace("partition", "/?(year|month|day)=", "-").substr(2, 10) < cutoff)
        .orderBy("partition")
    )
    names = [row.partition for row in expired.collect()]
    for name in names:
        spec = ", ".join("{}='{}'".format(*part.split("=")) for part in name.split("/"))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return names


