"""Streams built from the batch operators.

Row-level work and windows run in the stream; checks need distinct counts over
two days, so each trigger recomputes them from the table. KPIs are folded from
partial sums that each batch adds to.

A batch may run again after a failure. Every sink takes that: its rows replace
those that the batch had written (partitions named by stream and batch), or
those of the same keys. The moment of a batch, which stands for times that its
rows lack, is noted beside the checkpoint when it first runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telepulse.functions.calendar import AsOf, moment_literal, utc_moment, with_partition_columns
from telepulse.operators import ingest, kpi, quality, windows
from telepulse.operators.filters import drop_outliers
from telepulse.schema import PARTITION_COLUMNS, TELEMETRY_COLUMNS
from telepulse.sources.files import read_note, remove_folder, write_note
from telepulse.sources.tables import add_partials, append_metrics, merge_window_stats, read_partials

Trigger = dict[str, object]

# Everything that is there now, then stop; used by tests and backfills.
ONCE: Trigger = {"availableNow": True}
EVERY_MINUTE: Trigger = {"processingTime": "1 minute"}
EVERY_5_MINUTES: Trigger = {"processingTime": "5 minutes"}
EVERY_10_MINUTES: Trigger = {"processingTime": "10 minutes"}
EVERY_30_MINUTES: Trigger = {"processingTime": "30 minutes"}

# A row may come as late as the scheduled job would still have read its hour.
LATENESS = "2 hours"


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name for the stream of a checkpoint folder, however the folder is spelled."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return hashlib.sha256(system.makeQualified(folder).toString().encode()).hexdigest()[:12]


def batch_moment(spark: SparkSession, checkpoint: str, batch_id: int, as_of: AsOf = None) -> str:
    """When a batch first ran, the same each time it runs; ``as_of`` where that is given."""
    if as_of is not None:
        return utc_moment(as_of).isoformat(sep=" ")
    note = f"{checkpoint.rstrip('/')}/moments/{batch_id}"
    moment = read_note(spark, note)
    if moment is None:
        moment = utc_moment().isoformat(sep=" ")
        write_note(spark, note, moment)
    return moment


def _each_batch(
    stream: DataFrame, checkpoint: str, trigger: Trigger, work: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).outputMode(mode)
    return writer.trigger(**trigger).start()


def write_batch(rows: DataFrame, path: str, partitions: list[str], batch: str) -> None:
    """Write what a batch puts into each partition, in place of what it had put there.

    AQE cuts a partition by size, so the number of files and tasks follows the rows of the batch.
    """
    keys = [*partitions, "batch"]
    (
        rows.withColumn("batch", F.lit(batch))
        .hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def stream_ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    *,
    quarantine: str | None = None,
    as_of: AsOf = None,
    trigger: Trigger = EVERY_MINUTE,
) -> StreamingQuery:
    """Validate messages (column ``value``) into the day-partitioned table, and the rejected ones into ``quarantine``.

    A batch is parsed once, into a folder beside the checkpoint that both tables are written from. Late events land
    in the partition of their own day; events without a time get the moment of their batch (or ``as_of``).
    """

    def work(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        moment = batch_moment(spark, checkpoint, batch_id, as_of)
        batch = f"{stream_name(spark, checkpoint)}-{batch_id}"
        parsed_path = f"{checkpoint.rstrip('/')}/parsed/{batch_id}"
        checked = ingest.ingest(messages)
        checked.write.mode("overwrite").parquet(parsed_path)
        parsed = spark.read.schema(checked.schema).parquet(parsed_path)
        accepted = ingest.accepted_events(parsed, as_of=moment)
        write_batch(accepted.select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS), path, PARTITION_COLUMNS, batch)
        if quarantine is not None:
            rejected = ingest.rejected_events(parsed).withColumn("rejected_at", moment_literal(moment).cast("timestamp"))
            write_batch(rejected.withColumn("date", F.col("rejected_at").cast("date")), quarantine, ["date"], batch)
        remove_folder(spark, parsed_path)

    return _each_batch(raw, checkpoint, trigger, work)


def streaming_window_stats(
    telemetry: DataFrame, *, lateness: str = LATENESS, deduplicate: bool = False, **options
) -> DataFrame:
    """``window_stats`` of a stream; a window is final once it is ``lateness`` old."""
    timed = telemetry.withColumn("event_time", F.col("event_time").cast("timestamp"))
    timed = timed.withWatermark("event_time", lateness)
    if deduplicate:
        timed = timed.dropDuplicatesWithinWatermark(["device_id", "event_time"])
    return windows.window_stats(timed, **options)


def stream_window_stats(
    telemetry: DataFrame,
    path: str,
    checkpoint: str,
    *,
    lateness: str = LATENESS,
    deduplicate: bool = False,
    trigger: Trigger = EVERY_10_MINUTES,
) -> StreamingQuery:
    """Merge final windows into a table partitioned by the day and hour they start in, a row a device and window."""
    stats = streaming_window_stats(telemetry, lateness=lateness, deduplicate=deduplicate)
    return _each_batch(stats, checkpoint, trigger, lambda rows, _: merge_window_stats(rows, path))


def finish_windows(
    telemetry: DataFrame, path: str, *, lateness: timedelta = timedelta(hours=2), deduplicate: bool = False
) -> None:
    """Add the windows that are too young for the stream to have written, from the stored table ``telemetry``.

    That is the end of a backfill, or of a source that has stopped. They are merged by device and window: a window
    that the stream writes later, or has written, is not there twice. Only the days since the youngest final window
    are read.
    """
    day = F.concat_ws("-", *PARTITION_COLUMNS)
    kept, latest = drop_outliers(telemetry), F.max(F.col("event_time").cast("timestamp_ntz"))
    last_day = telemetry.agg(F.max(day)).first()[0]  # from the folders' names
    newest = kept.where(day == last_day).agg(latest).first()[0] or kept.agg(latest).first()[0]
    if newest is None:
        return
    since = newest - lateness - timedelta(hours=1)
    young = telemetry.where((day >= f"{since:%Y-%m-%d}") & (F.col("event_time") >= moment_literal(since)))
    if deduplicate:
        young = young.dropDuplicates(["device_id", "event_time"])
    stats = windows.window_stats(young.withColumn("event_time", F.col("event_time").cast("timestamp")))
    merge_window_stats(stats.where(F.col("window_end") > moment_literal(newest - lateness)), path)


def stream_kpis(
    telemetry: DataFrame,
    partials_path: str,
    metrics_path: str,
    checkpoint: str,
    *,
    as_of: AsOf = None,
    trigger: Trigger = EVERY_5_MINUTES,
) -> StreamingQuery:
    """Add each batch to the partial sums of its days, and publish the KPIs of the batch's day from them.

    No raw row is read twice: a trigger reads the batch and one snapshot of each day that the batch has rows of.
    """

    def work(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        moment = batch_moment(spark, checkpoint, batch_id, as_of)
        add_partials(kpi.kpi_partials(rows), partials_path, batch_id)
        kpis = kpi.kpis_of_partials(read_partials(spark, partials_path, moment, up_to=batch_id), as_of=moment)
        append_metrics(kpi.kpi_metrics(kpis, as_of=moment), metrics_path)

    return _each_batch(telemetry, checkpoint, trigger, work)


def stream_quality(
    ticks: DataFrame,
    table: Callable[[], DataFrame],
    metrics_path: str,
    checkpoint: str,
    *,
    as_of: AsOf = None,
    trigger: Trigger = EVERY_30_MINUTES,
) -> StreamingQuery:
    """Publish the check metrics at each trigger.

    The checks look for missing data, so give it ``ticks`` that also come
    without data, such as the rate source.
    """

    def work(rows: DataFrame, batch_id: int) -> None:
        moment = batch_moment(rows.sparkSession, checkpoint, batch_id, as_of)
        checks = quality.quality_checks(table(), as_of=moment)
        append_metrics(quality.quality_metrics(checks, as_of=moment), metrics_path)

    return _each_batch(ticks, checkpoint, trigger, work)
