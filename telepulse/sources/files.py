"""Text and Parquet readers of telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telepulse.functions.calendar import lenient_timestamp, with_partition_columns
from telepulse.schema import (
    PARTITION_COLUMNS,
    PARTITION_DDL,
    SIX_FIELD_COLUMNS,
    TELEMETRY_COLUMNS,
    TELEMETRY_CSV_DDL,
    TELEMETRY_DDL,
)

# Raw files that cannot be read are skipped; ``skipped_lines`` says what in the others is no record.
_TOLERANT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
_CSV_OPTIONS = {"mode": "PERMISSIVE", "nullValue": "", "sep": ","}


def _without_headers(df: DataFrame) -> DataFrame:
    """Drop lines that repeat the column names, wherever in a file they are."""
    text = ("device_id", "fleet_id", "event_time")
    is_header = F.lit(True)
    for name in text:
        is_header = is_header & F.col(name).eqNullSafe(F.lit(name))
    return df.filter(~is_header)


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", lenient_timestamp(F.col("event_time")))


def read_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Telemetry CSV under ``year=/month=/day=`` folders of one depth.

    Partition values stay zero-padded text. Files may or may not start with a
    header line; none of their data lines is skipped.
    """
    lines = (
        spark.read.options(**_CSV_OPTIONS, **_TOLERANT)
        .schema(f"{TELEMETRY_CSV_DDL}, {PARTITION_DDL}")
        .option("basePath", path)
        .csv(path)
    )
    return _typed(_without_headers(lines)).select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS)


# Names directly in a day's folder that are no hour's folder, as a pattern of the file system.
_NOT_AN_HOUR = "{[!h],h[!o],ho[!u],hou[!r],hour[!=]}*"


def read_mixed_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same where some files sit deeper, under ``hour=``: a partitioned scan of each depth, both pruned by filters."""
    day = f"{path.rstrip('/')}/year=*/month=*/day=*"
    depths = [depth for depth in (f"{day}/{_NOT_AN_HOUR}", f"{day}/hour=*") if _matches(spark, depth)]
    frames = []
    for depth in depths:
        lines = (
            spark.read.options(**_CSV_OPTIONS, **_TOLERANT)
            .schema(f"{TELEMETRY_CSV_DDL}, {PARTITION_DDL}" + (", hour string" if depth.endswith("hour=*") else ""))
            .option("basePath", path)
            .csv(depth)
        )
        frames.append(_typed(_without_headers(lines)).select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS))
    if not frames:
        return spark.createDataFrame([], f"{TELEMETRY_DDL}, {PARTITION_DDL}")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _matches(spark: SparkSession, pattern: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return len(hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path) or []) > 0


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of all lines under a folder; files that cannot be read are left out, as ``file_inventory`` shows."""
    lines = spark.read.options(**_TOLERANT).option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), "value")


def file_inventory(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """Every file under a folder that is not empty: path, length, the lines read of it, and whether it was skipped.

    The listing reads no content. A file that gave no line was skipped; one that breaks off later has the lines
    before that.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    read = lines.groupBy("path").agg(F.count("*").alias("lines"))
    return listed.join(read, "path", "left").select(
        "path", "length", F.coalesce("lines", F.lit(0)).alias("lines"), F.col("lines").isNull().alias("skipped")
    )


def parse_telemetry_lines(lines: DataFrame) -> DataFrame:
    """(value, path) text lines to telemetry; partition values come from the path."""
    parsed = lines.filter(F.length(F.trim("value")) > 0).select(
        F.from_csv("value", TELEMETRY_CSV_DDL, _CSV_OPTIONS).alias("record"),
        *[F.regexp_extract("path", rf"(?:^|/){key}=([^/]+)", 1).alias(key) for key in PARTITION_COLUMNS],
    )
    return _typed(_without_headers(parsed.select("record.*", *PARTITION_COLUMNS)))


def skipped_lines(lines: DataFrame) -> DataFrame:
    """(path, value) of the lines that are no full record: a wrong number of fields, or values of another type."""
    bad = "_no_record"
    options = {**_CSV_OPTIONS, "columnNameOfCorruptRecord": bad}
    record = F.from_csv("value", f"{TELEMETRY_CSV_DDL}, {bad} string", options)
    parsed = lines.filter(F.length(F.trim("value")) > 0).select("path", "value", record.alias("record"))
    is_header = F.col("value").startswith(",".join(TELEMETRY_COLUMNS[:3]))
    return parsed.filter(F.col(f"record.{bad}").isNotNull() & ~is_header).select("path", "value")


def parse_six_field_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of the older six-field record; what is no number becomes NULL."""
    part = F.split(F.col(column), ",")
    record = {name: F.try_element_at(part, F.lit(i + 1)) for i, name in enumerate(SIX_FIELD_COLUMNS)}
    for name in ("temperature", "humidity", "pressure"):
        record[name] = record[name].try_cast("double")
    record["timestamp"] = record["timestamp"].try_cast("bigint")
    return lines.select(*[c.alias(name) for name, c in record.items()])


def read_six_field_csv(spark: SparkSession, path: str) -> DataFrame:
    """The older record with its event time and partition columns, as the scheduled window job reads it."""
    lines = spark.read.options(**_TOLERANT).option("recursiveFileLookup", "true").text(path)
    records = parse_six_field_lines(lines)
    return with_partition_columns(records.withColumn("event_time", F.timestamp_millis("timestamp")))


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet telemetry table at ``path``; empty where none was written yet. A broken file fails the job."""
    schema = f"{TELEMETRY_DDL}, {PARTITION_DDL}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS)


def folders(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder, by name; nothing where it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in system.listStatus(hadoop_path)) if system.exists(hadoop_path) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """A small text file of the shared store, such as the moment of a run; None where there is none."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).collect()  # one line
    return rows[0].value if rows else None


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Put a small file into the store in place of what is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True)
    out.write(bytearray(data))
    out.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
